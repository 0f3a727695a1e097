"""One pass from bronze to silver and rejects, incremental runs, and what a run that dies leaves behind."""

import random
from dataclasses import replace
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, shown_plan, tuples

from skyair.functions.predicates import valid_reading
from skyair.operators.aggregation import daily_partials, daily_summary, merged_summary
from skyair.operators.cleaning import CORRUPT_LINE, KEPT, REASON, audit, audit_of, clean, dedup_newest, route
from skyair.operators.selection import latest
from skyair.plans import refining
from skyair.plans.medallion import FLIGHTS, READINGS, load_silver, refine, refine_new
from skyair.plans.refining import read_rejects, stored_audit, survivors
from skyair.plans.summaries import read_partials, refresh
from skyair.schemas import FLIGHTS as FLIGHTS_SCHEMA
from skyair.sources import folders
from skyair.sources.readers import CORRUPT
from skyair.sources.writers import append_load, write_json_batch, write_snapshot

ROWS = "sensor_id bigint, period__datetime_from__utc timestamp, value double, parameter string, location_id bigint"
KEYS = ["sensor_id", "period__datetime_from__utc"]
REQUIRED = ["value", "parameter"]


def random_rows(rng, n, days=range(6)):
    return [
        (rng.choice([1, 2, 3, None]), rng.choice([*(at("2026-01-01") + timedelta(days=d, hours=rng.randrange(2)) for d in days), None]),
         rng.choice([1.0, 2.0, -1.0, None, float("nan")]), rng.choice(["a", "b", None]), rng.randrange(3))
        for _ in range(n)
    ]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("validate_first", [False, True])
def test_routing_agrees_with_cleaning_and_audit(spark, keep_first, validate_first):
    df = spark.createDataFrame(random_rows(random.Random(1), 300), ROWS).repartition(5)
    rules = {"keys": KEYS, "required": REQUIRED, "valid": valid_reading(), "newest": ["location_id"], "keep_first": keep_first}
    routed = route(df, **rules, validate_first=validate_first).persist()
    assert routed.count() == 300 and not routed.filter(F.col(REASON).isNull()).count()
    kept = routed.filter(F.col(REASON) == KEPT).drop(REASON)
    assert tuples(kept) == tuples(clean(df, **rules, validate_first=validate_first))
    if not validate_first:
        counts = routed.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
        assert tuple(audit_of(counts).first()) == tuple(audit(df, **rules).first())


def test_routing_whole_rows_and_corrupt_lines(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (None, "{x"), (None, "{x")], "k int, bad string")
    routed = route(df, None, ["k"], corrupt="bad")
    assert tuples(routed, "k", REASON) == [(1, "duplicate"), (1, "kept"), (None, "corrupt"), (None, "corrupt"), (None, "missing")]


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


SOURCE = replace(READINGS, tiebreak=("value", "parameter", "location_id"))


def append(spark, lake, rows, load):
    append_load(spark.createDataFrame(rows, ROWS), f"{lake}/bronze/readings", f"load{load}", at("2026-02-01") + timedelta(days=load))


COLUMNS = ["sensor_id", "period__datetime_from__utc", "value", "parameter", "location_id", "_load_id"]


def state(spark, lake):
    silver = spark.read.parquet(f"{lake}/silver/readings")
    found = tuples(silver, *COLUMNS, "event_date"), tuples(read_rejects(spark, lake, "readings"), *COLUMNS, REASON)
    return [[repr(row) for row in rows] for rows in found]  # as text, since NaN differs from itself


def files(lake):
    return {p: p.stat().st_mtime_ns for layer in ("silver", "rejects") for p in Path(f"{lake}/{layer}/readings").rglob("*.parquet")}


@pytest.mark.parametrize("validate_first", [False, True])
def test_incremental_runs_equal_a_whole_one(spark, lake, validate_first):
    rng = random.Random(4)
    for load, days in enumerate([range(6), range(2), range(4, 7), range(1)]):
        append(spark, lake, random_rows(rng, 40, days), load)
        assert refine_new(spark, lake, ["readings"], validate_first, sources=[SOURCE]) == ["readings"]
        assert refine_new(spark, lake, ["readings"], validate_first, sources=[SOURCE]) == []
    found, counted = state(spark, lake), tuple(stored_audit(spark, lake, "readings").first())
    refine(spark, lake, ["readings"], validate_first, sources=[SOURCE])
    assert state(spark, lake) == found and found[0] and found[1]
    bronze = SOURCE.read(spark, f"{lake}/bronze/readings")
    assert counted[0] == bronze.count() == 160
    if not validate_first:
        assert counted == tuple(audit(bronze, **SOURCE.rules()).first())
    # after a whole run only what comes next is new
    assert refine_new(spark, lake, ["readings"], validate_first, sources=[SOURCE]) == []


def test_a_load_rewrites_its_own_days_only(spark, lake):
    day = lambda d, value=1.0: (1, at("2026-01-01") + timedelta(days=d), value, "a", 1)
    append(spark, lake, [day(0), day(1), day(2), day(2)], 0)
    refine_new(spark, lake, sources=[SOURCE])
    before = files(lake)
    append(spark, lake, [day(1, None), day(5)], 1)
    refine_new(spark, lake, sources=[SOURCE])
    after = files(lake)
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert {p.parent.name for p in changed} == {"event_date=2026-01-02", "event_date=2026-01-06"}
    # the newest copy of day 1 is bad, so silver holds the day no more
    assert tuples(spark.read.parquet(f"{lake}/silver/readings"), F.col("event_date").cast("string")) == [
        ("2026-01-01",), ("2026-01-03",), ("2026-01-06",),
    ]
    old = survivors(spark, lake, "readings", [at("2026-01-02").date()])
    assert "PartitionFilters: [isnotnull(event_date" in shown_plan(old) and old.count() == 1


@pytest.mark.parametrize("steps", range(1, 8))
def test_a_run_that_dies_is_finished_by_the_next(spark, lake, monkeypatch, steps):
    rng = random.Random(9)
    append(spark, lake, random_rows(rng, 40, range(2)), 0)
    refine_new(spark, lake, sources=[SOURCE])
    append(spark, lake, random_rows(rng, 40, range(2)), 1)
    left = [steps]

    def failing(do):
        def run(*args):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("died")
            return do(*args)

        return run

    with monkeypatch.context() as patched:
        for module in (folders, refining):
            patched.setattr(module, "move", failing(folders.__dict__["move"]) if module is folders else folders.move)
        for name in ("publish", "add_files", "remove", "move"):
            patched.setattr(refining, name, failing(getattr(refining, name)))
        with pytest.raises(RuntimeError):
            refine_new(spark, lake, sources=[SOURCE])
    refine_new(spark, lake, sources=[SOURCE])
    found = state(spark, lake)
    refine(spark, lake, ["readings"], sources=[SOURCE])
    assert state(spark, lake) == found


def test_silver_without_days_takes_no_incremental_run(spark, lake):
    append(spark, lake, random_rows(random.Random(2), 40, range(2)), 0)
    refine(spark, lake, ["readings"], by_day=False, sources=[SOURCE])
    assert refine_new(spark, lake, sources=[SOURCE]) == []
    append(spark, lake, random_rows(random.Random(3), 40, range(2)), 1)
    with pytest.raises(ValueError, match="by day first"):
        refine_new(spark, lake, sources=[SOURCE])
    refine(spark, lake, ["readings"], sources=[SOURCE])
    append(spark, lake, random_rows(random.Random(5), 40, range(2)), 2)
    assert refine_new(spark, lake, sources=[SOURCE]) == ["readings"]


def test_summaries_follow_the_days_that_change(spark, lake):
    rng = random.Random(6)
    plain = lambda: tuples(daily_summary(spark.read.parquet(f"{lake}/silver/readings"), by=["location_id", "parameter"]))
    partials = lambda rows: daily_partials(rows, by=["location_id", "parameter"])
    found = lambda: tuples(merged_summary(read_partials(spark, lake, "readings"), ["location_id", "parameter", "reading_date"]))
    refreshed = []
    for load, days in enumerate([range(6), [2], [4, 5], [0]]):
        rows = [r for r in random_rows(rng, 60, days) if r[1]]
        append(spark, lake, rows, load)
        refine_new(spark, lake, sources=[SOURCE])
        refreshed.append(refresh(spark, lake, "readings", partials))
        assert [r[:3] for r in found()] == [r[:3] for r in plain()] and found()
        assert [r[3:] for r in found()] == [pytest.approx(r[3:]) for r in plain()]
        assert refresh(spark, lake, "readings", partials) == []
    assert refreshed == [None, ["event_date=2026-01-03"], ["event_date=2026-01-05", "event_date=2026-01-06"], ["event_date=2026-01-01"]]
    refine(spark, lake, ["readings"], sources=[SOURCE])
    assert refresh(spark, lake, "readings", partials) is None
    assert [r[:3] for r in found()] == [r[:3] for r in plain()]


def test_corrupt_lines_are_kept_among_the_rejects(spark, lake):
    row = dict.fromkeys(FLIGHTS_SCHEMA.names) | {"icao24": "a", "latitude": 1.0, "longitude": 1.0, "observed_at": at("2026-01-01")}
    write_json_batch(spark.createDataFrame([tuple(row.values())] * 2, FLIGHTS_SCHEMA), f"{lake}/bronze/flights")
    bad = ["{broken", "[1", "{broken"]
    spark.createDataFrame([(x,) for x in bad], "value string").coalesce(1).write.mode("append").text(f"{lake}/bronze/flights")
    for run in (refine, refine_new):
        assert run(spark, lake, ["flights"]) == (["flights"] if run is refine else [])
        rejects = read_rejects(spark, lake, "flights")
        assert sorted(r[0] for r in rejects.filter(F.col(REASON) == CORRUPT_LINE).select(CORRUPT).collect()) == sorted(bad)
        assert tuple(stored_audit(spark, lake, "flights").first()) == (5, 4, 1, 1)
    spark.sql("DROP TABLE IF EXISTS flights_processed")
    load_silver(spark, lake, ["flights"])
    assert spark.table("flights_processed").columns == [*FLIGHTS_SCHEMA.names, "event_date"]
    assert FLIGHTS.read(spark, f"{lake}/bronze/flights").count() == 5


@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_a_snapshot_survives_a_job_that_dies(spark, tmp_path, monkeypatch, partition_by):
    path = str(tmp_path / "snapshot")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    write_snapshot(old, path, partition_by)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("v"), F.lit("c").alias("k"))
    with pytest.raises(Exception, match="no"):
        write_snapshot(broken, path, partition_by)
    assert tuples(spark.read.parquet(path), "v", "k") == [(1, "a"), (2, "b")]
    new = spark.createDataFrame([(3, "c")], "v int, k string")
    moves = []

    def dying(spark, source, target, do=folders.move):
        moves.append(target)
        if len(moves) == 2:  # the old snapshot is set aside, the new one not yet in place
            raise RuntimeError("died")
        do(spark, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(folders, "move", dying)
        with pytest.raises(RuntimeError):
            write_snapshot(new, path, partition_by)
    folders.recover(spark, path)
    assert tuples(spark.read.parquet(path), "v", "k") == [(1, "a"), (2, "b")]
    write_snapshot(new, path, partition_by)
    assert tuples(spark.read.parquet(path), "v", "k") == [(3, "c")]
    # a snapshot may be made out of itself
    write_snapshot(spark.read.parquet(path).select((F.col("v") + 1).alias("v"), "k"), path, partition_by)
    assert tuples(spark.read.parquet(path), "v", "k") == [(4, "c")]
    assert {p.name for p in tmp_path.iterdir()} == {"snapshot"}


def test_a_bucketed_table_is_read_by_key_without_a_shuffle(spark, lake, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS readings_processed")
    rows = [(n % 50, at("2026-01-01") + timedelta(hours=n % 90), float(n), "pm25", 1) for n in range(600)]
    append(spark, lake, rows, 0)
    refine(spark, lake, ["readings"], sources=[SOURCE])
    load_silver(spark, lake, ["readings"], sources=[SOURCE], buckets=6)
    table, silver = spark.table("readings_processed"), spark.read.parquet(f"{lake}/silver/readings")
    assert len([f for f in table.inputFiles()]) <= 6
    time = "period__datetime_from__utc"
    for ask in (
        lambda df: latest(df, ["sensor_id"], time, []),
        lambda df: dedup_newest(df, KEYS, ["_load_time"], []),
        lambda df: df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
    ):
        assert "Exchange" not in shown_plan(ask(table)) and "Exchange" in shown_plan(ask(silver))
        assert tuples(ask(table).select(*KEYS)) == tuples(ask(silver).select(*KEYS))
    # one sensor with most of the rows: the table keeps its days
    append(spark, lake, [(7, at("2026-03-01") + timedelta(minutes=n), 1.0, "pm25", 1) for n in range(900)], 1)
    refine(spark, lake, ["readings"], sources=[SOURCE])
    load_silver(spark, lake, ["readings"], sources=[SOURCE], buckets=6)
    assert "Exchange" in shown_plan(latest(spark.table("readings_processed"), ["sensor_id"], time, []))
    assert spark.table("readings_processed").count() == spark.read.parquet(f"{lake}/silver/readings").count()
