"""What must not grow faster than the input: what refining and loading shuffle and write."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from skyair.operators import skew
from skyair.operators.cleaning import may_have_hot_keys, route
from skyair.plans.medallion import READINGS, load_silver, refine
from skyair.sources.writers import append_load, with_lineage
from tests.helpers import shown_plan, tuples


def copies(spark):
    some = random.Random(5)
    rows = [(some.choice([1, 2, 3, None]), some.randrange(4), some.choice([None, -1.0, 2.0])) for _ in range(200)]
    return spark.createDataFrame(rows, "k long, at long, value double").repartition(3)


def routed(df):
    return route(df, ["k"], ["value"], F.col("value") >= 0, ["at"])


def test_routing_shuffles_once_without_hot_keys(spark):
    assert shown_plan(routed(copies(spark))).split("Physical Plan")[1].count("Exchange hashpartitioning") == 1


def test_routing_of_hot_keys_gives_the_same_rows(spark, monkeypatch):
    df = copies(spark).localCheckpoint()
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    split = routed(df)
    assert shown_plan(split).split("Physical Plan")[1].count("Exchange hashpartitioning") == 2
    whole = tuples(split)
    monkeypatch.undo()
    assert whole == tuples(routed(df))


def test_hot_keys_are_never_missed(spark, split_everything):
    assert may_have_hot_keys(spark.createDataFrame([(1,), (None,), (None,)], "k long"), ["k"])
    assert not may_have_hot_keys(spark.createDataFrame([(1,), (None,)], "k long"), ["k"])
    assert not may_have_hot_keys(spark.createDataFrame([], "k long"), ["k"])


def test_row_ids_stay_the_same_when_a_task_runs_again(spark):
    load = with_lineage(spark.range(20).repartition(4), "a", datetime(2026, 1, 1))
    assert tuples(load) == tuples(load)
    other = with_lineage(spark.range(20).repartition(4), "a", datetime(2026, 1, 1))
    assert load.union(other).select("_row_id").distinct().count() == 40


def test_a_table_is_dealt_by_day_only_where_silver_is(spark, tmp_path):
    lake, saved = str(tmp_path), []
    rows = [(1, datetime(2026, 1, day), 1.0, "pm25", 1, "a", "AT") for day in (1, 2)]
    names = "sensor_id long, period__datetime_from__utc timestamp, value double, parameter string, location_id long, location_name string, country string"
    append_load(spark.createDataFrame(rows, names), f"{lake}/bronze/readings", "1")
    for by_day in (False, True):
        refine(spark, lake, ["readings"], by_day=by_day, sources=[READINGS])
        load_silver(spark, lake, ["readings"], lambda df, name, partition_by=(): saved.append((df.count(), list(partition_by))))
    assert saved == [(2, []), (2, ["event_date"])]
