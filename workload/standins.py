"""Readings, flights and metadata read out of the test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.operators.joining import enrich

POLLUTANTS = {"avg_pm25": "AF", "avg_pm10": "NO", "avg_no2": "RO", "avg_o3": "RF"}
PARAMETERS = ("AF", "AO", "NF", "NO", "RF", "RO", "XX")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as readings: the supplier is the location, flag and status are the parameter."""
    places = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    placed = enrich(table(spark, sf_dir, "lineitem"), places.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
    return placed.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sensor_id"),
        F.col("l_shipdate").alias("period__datetime_from__utc"),
        F.col("l_quantity").alias("value"),
        F.concat("l_returnflag", "l_linestatus").alias("parameter"),
        F.col("l_suppkey").alias("location_id"),
        F.col("s_name").alias("location_name"),
        F.col("n_name").alias("country"),
    )


READINGS = """
readings AS (
  SELECT l_orderkey * 10 + l_linenumber AS sensor_id, l_shipdate AS period__datetime_from__utc,
         l_quantity AS value, l_returnflag || l_linestatus AS parameter, l_suppkey AS location_id,
         s_name AS location_name, n_name AS country
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""


def gappy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with missing and negative values: the test tables hold neither."""
    return readings(spark, sf_dir).withColumns(
        {
            "sensor_id": F.nullif(F.col("sensor_id") % 5000, F.lit(77)),
            "location_id": F.nullif("location_id", F.lit(3)),
            "parameter": F.nullif("parameter", F.lit("NF")),
            "value": F.nullif(F.col("value") - 5, F.lit(8.0)),
        }
    )


GAPPY = (
    READINGS
    + """,
gappy AS (
  SELECT nullif(sensor_id % 5000, 77) AS sensor_id, period__datetime_from__utc,
         nullif(value - 5, 8.0) AS value, nullif(parameter, 'NF') AS parameter,
         nullif(location_id, 3) AS location_id, location_name, country
  FROM readings)
"""
)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as state records: the customer is the aircraft."""
    owners = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = enrich(table(spark, sf_dir, "orders"), owners.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return placed.select(
        F.col("c_mktsegment").alias("region"),
        F.col("o_custkey").cast("string").alias("icao24"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("callsign"),
        F.col("n_name").alias("origin_country"),
        (F.col("o_orderkey") % 360 - 180).cast("double").alias("longitude"),
        (F.col("o_orderkey") % 180 - 90).cast("double").alias("latitude"),
        F.col("o_totalprice").alias("baro_altitude"),
        (F.col("o_orderstatus") == "F").alias("on_ground"),
        F.nullif((F.col("o_orderkey") % 300).cast("double"), F.lit(7.0)).alias("velocity"),
        F.col("c_acctbal").alias("true_track"),
        ((F.col("o_orderkey") % 41 - 20) / F.lit(4.0)).alias("vertical_rate"),
        (F.col("o_totalprice") + 30).alias("geo_altitude"),
        F.col("o_orderstatus").alias("squawk"),
        F.col("o_orderdate").alias("observed_at"),
        F.col("o_orderkey").alias("sequence"),
    )


FLIGHTS = """
flights AS (
  SELECT c_mktsegment AS region, CAST(o_custkey AS VARCHAR) AS icao24,
         nullif(o_orderpriority, '5-LOW') AS callsign, n_name AS origin_country,
         CAST(o_orderkey % 360 - 180 AS DOUBLE) AS longitude,
         CAST(o_orderkey % 180 - 90 AS DOUBLE) AS latitude, o_totalprice AS baro_altitude,
         o_orderstatus = 'F' AS on_ground, nullif(CAST(o_orderkey % 300 AS DOUBLE), 7.0) AS velocity,
         c_acctbal AS true_track, (o_orderkey % 41 - 20) / 4.0::DOUBLE AS vertical_rate,
         o_totalprice + 30 AS geo_altitude, o_orderstatus AS squawk, o_orderdate AS observed_at,
         o_orderkey AS sequence
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as nested location metadata with seven sensors each, the seventh of them silent."""
    placed = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    names = F.array(*map(F.lit, PARAMETERS))

    def day(number):
        return F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), number), "yyyy-MM-dd'T'00:00:00'Z'")

    def sensor(i):
        last = F.when(i < 7, day((F.col("s_suppkey") % 28).cast("int") - i))
        return F.struct(
            (F.col("s_suppkey") * 10 + i).alias("id"),
            F.struct(F.element_at(names, i).alias("name")).alias("parameter"),
            F.struct(last.alias("utc")).alias("datetimeLast"),
        )

    return placed.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("country"),
        F.struct(day((F.col("s_suppkey") % 28).cast("int")).alias("utc")).alias("datetimeLast"),
        F.transform(F.sequence(F.lit(1), F.lit(7)), sensor).alias("sensors"),
    )


SENSORS = """
sensors AS (
  SELECT n_name AS country, s_suppkey AS location_id, s_name AS location_name,
         TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 28 AS INTEGER)) AS location_last,
         s_suppkey * 10 + i AS sensor_id,
         list_extract(['AF', 'AO', 'NF', 'NO', 'RF', 'RO', 'XX'], i) AS parameter,
         CASE WHEN i < 7 THEN TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 28 - i AS INTEGER)) END
           AS sensor_last
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, (SELECT unnest([1, 2, 3, 4, 5, 6, 7])::INTEGER AS i))
"""


def event_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users as locations; a parameter is an event type and one of three groups of users, so that coverage differs."""
    events = table(spark, sf_dir, "events")
    grouped = F.concat_ws("_", "event_type", F.col("user_id") % 3)
    pairs = events.select("user_id", grouped.alias("event_type")).distinct()
    last = events.groupBy("user_id").agg(F.max("ts").alias("location_last"))
    placed = pairs.join(last, "user_id").join(
        table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey")
    )
    return placed.select(
        F.col("c_nationkey").alias("country"),
        F.col("user_id").alias("location_id"),
        F.col("event_type").alias("parameter"),
        "location_last",
    )


EVENT_SENSORS = """
event_sensors AS (
  SELECT c_nationkey AS country, user_id AS location_id, event_type AS parameter, location_last
  FROM (SELECT DISTINCT user_id, event_type || '_' || CAST(user_id % 3 AS VARCHAR) AS event_type FROM events)
  JOIN (SELECT user_id, max(ts) AS location_last FROM events GROUP BY user_id) USING (user_id)
  JOIN customer ON user_id = c_custkey)
"""


def payloads(spark_frame: DataFrame) -> DataFrame:
    """Events as raw state payloads, two states each; every event of type ``error`` is cut short."""
    epoch = F.unix_seconds(as_instant(spark_frame, "ts"))
    user = F.col("user_id").cast("string")
    first = F.concat(
        F.lit('["'), user, F.lit('", "  '), F.col("event_type"), F.lit(' \\t", "Nowhere", 1, 2, '),
        F.col("value").cast("string"), F.lit(', -12.5, null, true, '), F.col("event_id").cast("string"),
        F.lit('.5, 90, -1.25, [7, 8], "n/a", "0042", false, 0]'),
    )
    second = F.concat(F.lit('["x'), user, F.lit('", "   ", "Nowhere", null, null, 3.5, 4.5, 100, false]'))
    whole = F.concat(F.lit('{"time": '), epoch.cast("string"), F.lit(', "states": ['), first, F.lit(", "), second, F.lit("]}"))
    broken = F.col("event_type") == "error"
    text = F.when(broken, F.substring(whole, 1, 30)).otherwise(whole)
    return spark_frame.select("event_id", text.alias("value"))
