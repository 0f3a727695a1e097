import math
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import tuples

from skyair.functions.predicates import valid_reading
from skyair.operators.cleaning import (
    MissingColumns,
    audit,
    clean,
    dedup_first,
    dedup_newest,
    dedup_rows,
    require,
)

SCHEMA = "sensor_id bigint, t int, value double, load string, row string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_newest_copy_survives_and_ties_go_to_the_largest_row(spark):
    rows = [
        (1, 1, 5.0, "a", "r1"),
        (1, 1, 6.0, "b", "r2"),
        (2, 1, 1.0, "a", "r3"),
        (2, 1, 2.0, "a", "r4"),
        (3, 1, None, None, "r5"),
        (3, 1, 9.0, "a", "r6"),
    ]
    for parts in (1, 3, 7):
        assert tuples(dedup_newest(frame(spark, rows, parts), ["sensor_id", "t"], ["load"]), "row") == [
            ("r2",),
            ("r4",),
            ("r6",),
        ]


def test_dedup_needs_no_other_column_when_told_so(spark):
    out = dedup_newest(frame(spark, [(1, 1, 5.0, "a", "x"), (1, 1, 6.0, "b", "y")]), ["sensor_id", "t"], ["load"], ())
    assert tuples(out, "row") == [("y",)]


def test_first_copy_survives(spark):
    rows = [(1, 1, 5.0, "b", "late"), (1, 1, 6.0, "a", "early"), (1, 2, 6.0, "c", "only")]
    assert tuples(dedup_first(frame(spark, rows), ["sensor_id", "t"], ["load"]), "row") == [("early",), ("only",)]


def test_null_keys_are_one_group(spark):
    rows = [(None, 1, 1.0, "a", "x"), (None, 1, 2.0, "b", "y"), (None, 2, 3.0, "a", "z")]
    assert tuples(dedup_newest(frame(spark, rows), ["sensor_id", "t"], ["load"]), "row") == [("y",), ("z",)]


def test_whole_row_dedup(spark):
    rows = [(1, 1, 1.0, "a", "x")] * 3 + [(1, 1, 1.0, "b", "x"), (None, None, None, None, None), (None,) * 5]
    assert dedup_rows(frame(spark, rows)).count() == 3


def test_columns_that_cannot_be_ordered_do_not_break_ties(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS t, map('a', 1) AS m UNION ALL SELECT 1, 3, map('b', 2)")
    assert dedup_newest(df, ["k"], ["t"]).select("t").collect()[0][0] == 3


def test_require_drops_null_and_nan(spark):
    rows = [(1, 1, None, "a", "x"), (1, 1, math.nan, "a", "y"), (None, 1, 1.0, "a", "z"), (1, 1, 0.0, "a", "ok")]
    assert tuples(require(frame(spark, rows), ["value", "sensor_id"]), "row") == [("ok",)]


BAD_NEWER = [
    (1, 1, 5.0, "a", "good"),
    (1, 1, None, "b", "newer is null"),
    (2, 1, 5.0, "a", "good"),
    (2, 1, -1.0, "b", "newer is negative"),
    (3, 1, 5.0, "a", "fine"),
    (None, 1, 5.0, "a", "no sensor"),
]
RULES = {"keys": ["sensor_id", "t"], "required": ["value", "t"], "newest": ["load"]}


def test_order_of_steps_decides_what_is_lost(spark):
    df = frame(spark, BAD_NEWER)
    kept = clean(df, valid=valid_reading(), **RULES)
    assert tuples(kept, "row") == [("fine",), ("no sensor",)]
    lossless = clean(df, valid=valid_reading(), validate_first=True, **RULES)
    assert tuples(lossless, "row") == [("fine",), ("good",), ("good",), ("no sensor",)]


def test_required_columns_are_a_parameter(spark):
    rules = {**RULES, "required": ["sensor_id", "value", "t"]}
    assert tuples(clean(frame(spark, BAD_NEWER), valid=valid_reading(), **rules), "row") == [("fine",)]


def test_missing_column_is_an_error(spark):
    df = frame(spark, BAD_NEWER)
    for rules in ({**RULES, "keys": ["icao24"]}, {**RULES, "required": ["nope"]}, {**RULES, "newest": ["nope"]}):
        with pytest.raises(MissingColumns):
            clean(df, **rules)


def test_without_keys_whole_rows_are_compared(spark):
    rows = [(1, 1, 1.0, "a", "x")] * 2 + [(1, 1, -1.0, "a", "x"), (1, 1, None, "a", "x")]
    assert clean(frame(spark, rows), None, ["value"], valid_reading()).count() == 1


def test_empty_input(spark):
    df = frame(spark, [])
    assert clean(df, valid=valid_reading(), **RULES).count() == 0
    assert tuple(audit(df, valid=valid_reading(), **RULES).first()) == (0, 0, 0, 0)


def test_audit_counts_each_step(spark):
    assert tuple(audit(frame(spark, BAD_NEWER), valid=valid_reading(), **RULES).first()) == (6, 4, 3, 2)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_invariants_on_random_rows(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, 1, 2, 3]),
            rng.randrange(5),
            rng.choice([None, math.nan, -1.0, 0.0, 2.5]),
            rng.choice("abc"),
            str(rng.randrange(3)),
        )
        for _ in range(200)
    ]
    df = frame(spark, rows, rng.randrange(1, 6))
    out = clean(df, valid=valid_reading(), **RULES)
    cleaned = tuples(out)
    assert len({(r[0], r[1]) for r in cleaned}) == len(cleaned)
    assert all(r[2] is not None and r[2] >= 0 for r in cleaned)
    assert tuples(clean(out, valid=valid_reading(), **RULES)) == cleaned
    counts = tuple(audit(df, valid=valid_reading(), **RULES).first())
    assert counts[0] == 200 and list(counts) == sorted(counts, reverse=True) and counts[-1] == len(cleaned)
    everything = clean(df, valid=valid_reading(), validate_first=True, **RULES)
    good_keys = {(r[0], r[1]) for r in rows if r[2] is not None and r[2] >= 0}
    assert {(r[0], r[1]) for r in tuples(everything)} == good_keys


def test_dedup_prunes_before_the_shuffle(spark):
    plan = dedup_newest(frame(spark, []), ["sensor_id", "t"], ["load"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_filters_reach_the_scan_when_validated_first(spark, tmp_path):
    frame(spark, BAD_NEWER).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    plan = clean(df, valid=F.col("value") >= 0, validate_first=True, **RULES)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(value,0.0)" in plan
