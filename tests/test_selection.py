import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, tuples

from skyair.operators.selection import (
    active_locations,
    backfill_from,
    backfill_tail,
    backfill_window,
    covering_locations,
    latest,
    newest_rows,
)

READINGS = "sensor string, t timestamp, n int"


def test_latest_breaks_ties_by_content(spark):
    rows = [("a", at("2026-01-01"), 1), ("a", at("2026-01-01"), 2), ("a", at("2025-12-31"), 9), (None, at("2026-01-01"), 5)]
    for parts in (1, 4):
        assert tuples(latest(spark.createDataFrame(rows, READINGS).repartition(parts), ["sensor"], "t"), "sensor", "n") == [
            ("a", 2),
            (None, 5),
        ]


WINDOW = [
    ("old", at("2020-01-08"), 1),
    ("old", at("2020-01-01"), 2),  # exactly on the bound
    ("old", at("2019-12-31T23:59:59"), 3),
    ("new", at("2026-01-08T00:00:00.700000"), 4),
    ("new", at("2026-01-01T00:00:00.100000"), 5),  # inside: the bound is on the full second
    (None, at("2026-05-08"), 6),
    (None, at("2026-04-08"), 7),
    ("none", None, 8),
]


def test_window_is_anchored_at_each_sensor(spark):
    df = spark.createDataFrame(WINDOW, READINGS)
    assert tuples(backfill_window(df, ["sensor"], "t", 7), "n") == [(1,), (2,), (4,), (5,), (6,)]


def test_window_with_hot_keys_split(spark, split_everything):
    df = spark.createDataFrame(WINDOW, READINGS).repartition(5)
    out = backfill_window(df, ["sensor"], "t", 7)
    assert tuples(out, "n") == [(1,), (2,), (4,), (5,), (6,)]
    assert out.columns == df.columns


def test_window_from_metadata(spark):
    df = spark.createDataFrame(WINDOW, READINGS).withColumn("seen", F.lit(at("2026-01-08")))
    assert tuples(backfill_from(df, "t", "seen", 7), "n") == [(4,), (5,), (6,), (7,)]


@pytest.mark.parametrize("n, expected", [(1, 2), (2, 4), (3, 5), (5, 5), (0, 5), (None, 5)])
def test_newest_rows_per_sensor(spark, n, expected):
    rows = [("a", at(f"2026-01-0{d}"), d) for d in (1, 2, 3)] + [("b", at(f"2026-01-0{d}"), d) for d in (1, 2)]
    out = newest_rows(spark.createDataFrame(rows, READINGS), ["sensor"], "t", n)
    assert out.count() == expected
    if n == 1:
        assert tuples(out, "sensor", "n") == [("a", 3), ("b", 2)]


@pytest.mark.parametrize("pruned_up_to, steps", [("10", 3), ("1000", 2)])
def test_many_rows_per_key_are_ranked_in_steps(spark, pruned_up_to, steps):
    rows = [("a", at("2026-01-01") + timedelta(seconds=i), i) for i in range(60)] + [("b", at("2026-01-01"), 1)]
    df = spark.createDataFrame(rows, READINGS).repartition(6)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", pruned_up_to)
    try:
        out = newest_rows(df, ["sensor"], "t", 20)
        assert out._jdf.queryExecution().analyzed().toString().count("row_number") == steps
        assert tuples(out.filter("sensor = 'a'"), "n") == sorted(((i,) for i in range(40, 60)), key=repr)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("n", [0, 1, 3, 50])
def test_capped_window_equals_window_then_cap(spark, seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), at("2026-01-01") + timedelta(hours=rng.randrange(600)), i) for i in range(120)]
    df = spark.createDataFrame(rows, READINGS)
    expected = newest_rows(backfill_window(df, ["sensor"], "t", 7), ["sensor"], "t", n)
    assert tuples(backfill_tail(df, ["sensor"], "t", 7, n)) == tuples(expected)


SENSORS = "country string, location_id bigint, parameter string, location_last timestamp"
TARGETS = ["pm25", "no2", "o3"]


# country, location, parameter, last: three places of one country and what they carry
PLACES = [
    ("US", 1, "pm25", at("2026-01-04")),
    ("US", 2, "pm25", at("2026-01-03")),
    ("US", 2, "temperature", at("2026-01-03")),
    ("US", 3, "pm25", at("2026-01-02")),
    ("US", 3, "no2", at("2026-01-02")),
    ("US", 4, "o3", None),
    ("US", 5, "temperature", at("2026-01-05")),
    ("PK", 9, "no2", at("2026-01-01")),
    ("PK", 8, "no2", at("2026-01-01")),
]


@pytest.mark.parametrize(
    "k, active, covering",
    [
        (1, {1, 8}, {1, 8}),
        (2, {1, 2, 8, 9}, {1, 3, 8, 9}),
        (3, {1, 2, 3, 8, 9}, {1, 3, 4, 8, 9}),
        (4, {1, 2, 3, 4, 8, 9}, {1, 2, 3, 4, 8, 9}),
        (9, {1, 2, 3, 4, 8, 9}, {1, 2, 3, 4, 8, 9}),
    ],
)
def test_chosen_places(spark, k, active, covering):
    df = spark.createDataFrame(PLACES, SENSORS).repartition(3)
    assert {r.location_id for r in active_locations(df, TARGETS, k).collect()} == active
    assert {r.location_id for r in covering_locations(df, TARGETS, k).collect()} == covering


@pytest.mark.parametrize("seed", range(4))
def test_properties_of_the_choice(spark, seed):
    """A place is covering exactly if some parameter has no earlier carrier; the rest are the most recent others."""
    rng = random.Random(seed)
    rows = []
    for country in ("US", "PK", None):
        for location in range(8):
            last = rng.choice([None, at("2026-01-01") + timedelta(days=rng.randrange(4))])
            for parameter in rng.sample([*TARGETS, "temperature"], rng.randrange(1, 4)):
                rows.append((country, location, parameter, last))
    targeted = [r for r in rows if r[2] in TARGETS]
    rank = lambda r: (-(r[3] or at("1990-01-01")).timestamp(), r[1])
    first = {min((r for r in targeted if r[0] == c and r[2] == p), key=rank)[:2] for c, _, p, _ in targeted}
    age = {r[:2]: rank(r) for r in targeted}
    df = spark.createDataFrame(rows, SENSORS).repartition(3)
    for k in (1, 3, 20):
        chosen = [(r.country, r.location_id, r.adds_parameter) for r in covering_locations(df, TARGETS, k).collect()]
        for country in {c for c, _ in age}:
            own = {loc: adds for c, loc, adds in chosen if c == country}
            assert all(adds == ((country, loc) in first) for loc, adds in own.items())
            others = [p for p in age if p[0] == country and p[1] not in own]
            assert len(own) == min(k, len(own) + len(others))
            for adds in (True, False):
                inside = [age[country, loc] for loc, a in own.items() if a == adds]
                outside = [age[p] for p in others if (p in first) == adds]
                assert not inside or not outside or max(inside) < min(outside)
            assert all(own.values()) or not any(p in first for p in others)
