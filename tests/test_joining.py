import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import shown_plan, tuples

from skyair.operators.joining import (
    aligned_full_join,
    conform_country,
    enrich,
    full_join,
    parse_boxes,
    place_boxes,
    tag_regions,
    unmapped_countries,
)
from skyair.operators.ranking import spread
from skyair.operators.skew import hot_keys, lookup_join, salted_join


@pytest.mark.parametrize("join", [full_join, aligned_full_join])
def test_full_join_merges_keys_and_never_matches_nulls(spark, join):
    left = spark.createDataFrame([("US", 1, 10), ("PK", 1, 20), (None, 1, 30)], "country string, day int, a int")
    right = spark.createDataFrame([("US", 1, 7), ("GB", 1, 8), (None, 1, 9)], "country string, day int, b int")
    out = join(left, right, ["country", "day"])
    assert out.columns == ["country", "day", "a", "b"]
    assert tuples(out) == sorted(
        [("US", 1, 10, 7), ("PK", 1, 20, None), ("GB", 1, None, 8), (None, 1, 30, None), (None, 1, None, 9)], key=repr
    )


READINGS = [(1, 0.5), (1, 0.6), (2, 0.7), (9, 0.8), (None, 0.9)]
SENSORS = [(1, "US", "pm25"), (2, "PK", "no2"), (2, "PK", "second entry"), (3, "PK", "o3"), (None, "??", "??")]


def enriched(spark):
    readings = spark.createDataFrame(READINGS, "sensor_id bigint, value double").repartition(3)
    sensors = spark.createDataFrame(SENSORS, "sensor_id bigint, country string, parameter string")
    return enrich(readings, sensors)


def test_enrich(spark):
    out = enriched(spark)
    assert out.columns == ["sensor_id", "value", "country", "parameter"]
    assert tuples(out) == [
        (1, 0.5, "US", "pm25"),
        (1, 0.6, "US", "pm25"),
        (2, 0.7, "PK", "no2"),
        (2, 0.7, "PK", "second entry"),
    ]
    assert "BroadcastHashJoin" in shown_plan(out)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("seed", [1, 2])
def test_split_join_equals_plain_join(spark, split_everything, how, seed):
    rng = random.Random(seed)
    big = [(rng.choice([None, 1, 1, 1, 1, 2, 3, 4]), rng.choice("xy"), i % 7) for i in range(300)]
    other = [(rng.choice([None, 1, 2, 3, 8]), rng.choice("xyz"), i) for i in range(20)]
    left = spark.createDataFrame(big, "k int, c string, v int").repartition(6)
    right = spark.createDataFrame(other, "k int, c string, w int")
    plain = left.join(right, ["k", "c"], how).select("k", "c", "v", "w")
    counts = left.groupBy("k", "c").agg(F.count(F.lit(1)).alias("__rows"))
    split = salted_join(left, right, ["k", "c"], hot_keys(counts, ["k", "c"]), how)
    assert tuples(split) == tuples(plain) == tuples(lookup_join(left, right, ["k", "c"], how))


def test_split_join_can_match_nulls(spark):
    left = spark.createDataFrame([(None, i) for i in range(6)] + [(1, 9)], "k int, v int").repartition(3)
    right = spark.createDataFrame([(None, "n"), (1, "one")], "k int, w string")
    hot = spark.createDataFrame([(None, 4)], "k int, __salts int")
    out = salted_join(left, right, ["k"], hot, "left", null_safe=True)
    assert tuples(out, "w") == [("n",)] * 6 + [("one",)]


def test_hot_keys_are_split_by_size(spark, monkeypatch):
    from skyair.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    counts = spark.createDataFrame([("a", 9), ("b", 10), ("c", 35), ("d", 1000)], "k string, __rows bigint")
    assert tuples(hot_keys(counts, ["k"])) == [("b", 1), ("c", 4), ("d", 100)]


def test_a_hot_key_is_spread_after_a_shuffle_by_that_key(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v")).repartition(8, "k")
    salted = rows.withColumn("salt", spread(rows, 16, ["k"])).groupBy("salt").count().collect()
    assert len(salted) == 16 and max(r["count"] for r in salted) < 400


BOXES = " north , 10, 10, 20, 20 |south,-5.5,0,12,15| turned, 30, 0, 20, 10"


def test_boxes_from_text(spark):
    assert tuples(parse_boxes(spark, BOXES)) == [
        ("north", 10.0, 10.0, 20.0, 20.0),
        ("south", -5.5, 0.0, 12.0, 15.0),
        ("turned", 30.0, 0.0, 20.0, 10.0),
    ]
    with pytest.raises(ValueError, match="four numbers"):
        parse_boxes(spark, "north,1,2,3")


POINTS = [
    (1, 11.0, 12.0),  # two overlapping boxes
    (2, 20.0, 20.0),  # on a corner
    (3, -5.5, 0.0),  # on the other corner
    (4, 20.0001, 15.0),
    (5, 0.5, 14.99),
    (6, None, 5.0),
    (7, float("nan"), 5.0),
    (8, 25.0, 5.0),  # only in the turned box, which contains nothing
]
TAGGED = [("north", 1), ("north", 2), ("south", 1), ("south", 3), ("south", 5)]


def points(spark):
    return spark.createDataFrame(POINTS, "id int, latitude double, longitude double")


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0])
def test_regions(spark, cell):
    out = tag_regions(points(spark), parse_boxes(spark, BOXES), cell=cell)
    assert out.columns == ["region", "id", "latitude", "longitude"]
    assert tuples(out, "region", "id") == TAGGED


def test_a_world_box_touches_few_cells(spark):
    boxes = parse_boxes(spark, BOXES + "|world,-90,-180,90,180|dot,11,12,11,12")
    placed = place_boxes(boxes, cell=0.1)
    assert placed.cells.groupBy("region").count().agg(F.max("count")).first()[0] <= 9
    expected = sorted([*TAGGED, ("dot", 1), *(("world", i) for i, lat, _ in POINTS if lat is not None and lat == lat)])
    assert tuples(tag_regions(points(spark), placed), "region", "id") == expected


def test_regions_form_no_cross_product(spark):
    plan = shown_plan(tag_regions(points(spark), parse_boxes(spark, BOXES)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


MAPPING = [("United States", "US"), ("USA", "US"), ("Pakistan", "PK"), ("Pakistan", "XX")]
COUNTRIES = [("United States", 1), ("US", 2), ("Pakistan", 3), ("Pakistan", 4), ("Narnia", 5), (None, 6)]


def test_conform_country(spark):
    mapping = spark.createDataFrame(MAPPING, "alias string, country string")
    df = spark.createDataFrame(COUNTRIES, "origin string, n int").repartition(3)
    assert tuples(conform_country(df, mapping, "origin")) == sorted(
        [("US", 1), ("US", 2), ("PK", 3), ("PK", 4), ("Narnia", 5), (None, 6)], key=repr
    )
    assert tuples(unmapped_countries(df, mapping, "origin")) == [("Narnia", 1), (None, 1)]


def test_conform_works_on_a_column_of_the_same_name(spark):
    mapping = spark.createDataFrame(MAPPING, "alias string, country string")
    df = spark.createDataFrame([("USA", 1)], "country string, n int").withColumn("m", F.lit(0))
    assert conform_country(df, mapping).columns == ["country", "n", "m"]
    assert tuples(conform_country(df, mapping)) == [("US", 1, 0)]
