import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.helpers import shown_plan, tuples

from skyair.operators.quality import (
    SchemaMismatch,
    column_checks,
    distinct_counts,
    duplicate_keys,
    null_counts,
    require_schema,
    row_count,
    schema_check,
)
from skyair.schemas import READINGS_CHECKS

SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)
ROWS = [(1, "pm25", 1.0, "US"), (1, "pm25", -1.0, "US"), (None, "no2", None, "US"), (2, None, 0.0, "PK"), (1, "pm25", 2.0, "PK")]


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_schema_check(spark):
    assert [r.passed for r in schema_check(table(spark), SCHEMA).collect()] == [True] * 4
    swapped = table(spark).select("parameter", "sensor_id", "value")
    assert [tuple(r) for r in schema_check(swapped, SCHEMA).collect()] == [
        (1, "sensor_id", "bigint", "string", False),
        (2, "parameter", "string", "bigint", False),
        (3, "value", "double", "double", True),
        (4, "country", "string", None, False),
    ]


def test_schema_gate(spark):
    assert require_schema(table(spark), SCHEMA).count() == 5
    with pytest.raises(SchemaMismatch, match="value expected double, found string"):
        require_schema(table(spark).withColumn("value", F.col("value").cast("string")), SCHEMA)


def test_counts(spark):
    assert row_count(table(spark)).first()[0] == 5
    assert tuple(null_counts(table(spark), ["value", "sensor_id"]).first()) == (1, 1)
    assert tuple(distinct_counts(table(spark), {"sensors": "sensor_id", "parameters": "parameter"}).first()) == (2, 2)


def test_duplicates_worst_first(spark):
    rows = [("a",)] * 2 + [("b",)] * 5 + [("c",)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "k string")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [("b", 5), (None, 3), ("a", 2)]
    assert duplicate_keys(df, ["k"], worst=1).count() == 1


def test_column_checks(spark):
    out = column_checks(table(spark), READINGS_CHECKS)
    assert shown_plan(out).split("== Physical Plan ==")[1].count("Scan") == 1
    assert [tuple(r) for r in out.collect()] == [
        ("not_null", "sensor_id", 1, False),
        ("not_null", "parameter", 1, False),
        ("not_null", "value", 1, False),
        ("non_negative", "value", 1, False),
        ("not_null", "country", 0, True),
    ]


def test_checks_with_the_schema_and_a_missing_column(spark):
    out = column_checks(table(spark).drop("country"), READINGS_CHECKS, SCHEMA)
    rows = tuples(out.filter("column_name = 'country'"))
    assert rows == [("not_null", "country", None, False), ("schema", "country", 1, False)]
    assert out.filter("check_name = 'schema' AND passed").count() == 3


def test_checks_pass_on_empty_input(spark):
    assert all(r.passed for r in column_checks(table(spark).limit(0), READINGS_CHECKS).collect())


def test_unknown_check_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown check"):
        column_checks(table(spark), [("positive", "value")])
