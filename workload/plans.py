"""Whole plans over the test tables: landing readings, marts over two forms of country names, checks with the load."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.operators.joining import parse_boxes, tag_regions
from skyair.plans.landing import land_readings
from skyair.plans.marts import daily_summary
from skyair.plans.medallion import FLIGHTS as FLIGHTS_SOURCE
from skyair.plans.medallion import READINGS as READINGS_SOURCE
from skyair.plans.medallion import check_loaded, load_silver, refine
from skyair.plans.models import default_models
from skyair.schemas import FLIGHTS as FLIGHTS_SCHEMA
from skyair.schemas import READINGS as READINGS_SCHEMA
from skyair.sources.readers import read_parquet_declared
from skyair.sources.scratch import shared_folder
from skyair.sources.writers import append_load, load_table, write_json_batch
from workload.registry import query, rounded
from workload.standins import FLIGHTS, PARAMETERS, READINGS, SENSORS, flights, locations, readings, table

TARGETS = PARAMETERS[:4]


@query(
    "p_land_readings",
    f"""
    WITH {SENSORS},
    candidates AS (SELECT DISTINCT country, location_id, parameter, location_last FROM sensors WHERE parameter IN {TARGETS}),
    firsts AS (
      SELECT *, row_number() OVER (PARTITION BY country, parameter ORDER BY location_last DESC NULLS LAST, location_id) = 1 AS new
      FROM candidates),
    places AS (
      SELECT country, location_id FROM (
        SELECT *, row_number() OVER (PARTITION BY country ORDER BY new DESC, location_last DESC NULLS LAST, location_id) AS rn
        FROM (SELECT country, location_id, location_last, bool_or(new) AS new FROM firsts GROUP BY ALL))
      WHERE rn <= 3),
    measured AS (
      SELECT l_suppkey * 10 + l_linenumber AS sensor_id, l_shipdate AS at_time, l_orderkey * 10.0::DOUBLE AS value FROM lineitem),
    joined AS (
      SELECT m.*, parameter, location_id, location_name, country, row_number() OVER (
        PARTITION BY sensor_id ORDER BY at_time DESC, value DESC) AS rn
      FROM measured m JOIN sensors USING (sensor_id) JOIN places USING (country, location_id)
      WHERE parameter IN {TARGETS} AND sensor_last IS NOT NULL)
    SELECT sensor_id, CAST(at_time AS VARCHAR) AS at_time, value, parameter, location_id, location_name, country, 'first' AS load_id
    FROM joined WHERE rn <= 5
    """,
)
def land(spark, sf_dir):
    """Locations and raw measurements to bronze, read back with the declared schema."""
    items = table(spark, sf_dir, "lineitem")
    time = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"))
    measurements = items.select(
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("sensor_id"),
        (F.col("l_orderkey") * F.lit(10.0)).alias("value"),
        F.struct(time.alias("datetimeFrom")).alias("period"),
    )
    folder = shared_folder(spark, "landed-readings")
    land_readings(
        locations(spark, sf_dir), measurements, folder, "first", datetime(2026, 1, 1), targets=TARGETS, rows_per_sensor=5, days=None
    )
    bronze = read_parquet_declared(spark, folder, READINGS_SCHEMA)
    return bronze.select(
        "sensor_id", F.col("period__datetime_from__utc").alias("at_time"), "value", "parameter", "location_id",
        "location_name", "country", F.col("_load_id").alias("load_id"),
    )


@query(
    "j3_world_box",
    """
    SELECT region, event_id FROM (
      SELECT event_id, user_id % 180 - 90.0 AS lat, event_id % 360 - 180.0 AS lon FROM events)
    JOIN (VALUES ('world', -90.0, -180.0, 90.0, 180.0), ('small', 1.05, 2.0, 1.15, 2.5), ('north', 10.0, 10.0, 60.0, 60.0))
      AS b(region, lamin, lomin, lamax, lomax)
      ON lat BETWEEN lamin AND lamax AND lon BETWEEN lomin AND lomax
    """,
)
def world_box(spark, sf_dir):
    """Boxes of every size on fine cells."""
    boxes = parse_boxes(spark, "world,-90,-180,90,180|small,1.05,2,1.15,2.5|north,10,10,60,60")
    points = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 180 - 90.0).cast("double").alias("latitude"),
        (F.col("event_id") % 360 - 180.0).cast("double").alias("longitude"),
    )
    return tag_regions(points, boxes, cell=0.1).select("region", "event_id")


@query(
    "j4_default_models",
    f"""
    WITH {READINGS}, {FLIGHTS},
    a AS (SELECT country, reading_date, round(avg(mean), 6) AS avg_pm25
          FROM (SELECT country, location_id, location_name, CAST(period__datetime_from__utc AS DATE) AS reading_date, avg(value) AS mean
                FROM readings WHERE parameter = 'AF' GROUP BY ALL) GROUP BY ALL),
    f AS (SELECT origin_country AS country, CAST(observed_at AS DATE) AS reading_date, count(DISTINCT icao24) AS flight_count
          FROM flights GROUP BY ALL)
    SELECT country, CAST(reading_date AS VARCHAR) AS reading_date, avg_pm25, flight_count FROM a JOIN f USING (country, reading_date)
    """,
)
def default_marts(spark, sf_dir):
    """Readings name a country by a code, flights by its name: the default correlation matches them by the mapping."""
    coded = F.concat(F.lit("C-"), F.reverse("country"))
    air = readings(spark, sf_dir).withColumn("country", coded).withColumn(
        "parameter", F.when(F.col("parameter") == "AF", "pm25").otherwise(F.col("parameter"))
    )
    name = F.col("n_name")
    codes = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("C-"), F.reverse(name)).alias("alias"), name.alias("country")
    )
    tables = {"daily_summary": daily_summary(air), "staging_flights": flights(spark, sf_dir)}
    model = next(m for m in default_models(codes) if m.name == "flight_air_correlation")
    matched = model.build(tables.__getitem__).filter("avg_pm25 IS NOT NULL AND flight_count IS NOT NULL")
    return rounded(matched.select("country", "reading_date", "avg_pm25", "flight_count"), "avg_pm25")


@query(
    "q_checks_with_load",
    f"""
    WITH {READINGS}, {FLIGHTS},
    r AS (SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY sensor_id, period__datetime_from__utc) = 1),
    f AS (SELECT DISTINCT icao24, observed_at FROM flights)
    SELECT 'readings' AS source, 'kept' AS check_name, count(*) AS failures FROM r
    UNION ALL SELECT 'flights', 'kept', count(*) FROM f
    UNION ALL SELECT s, c, 0 FROM (VALUES ('readings', 'has_rows'), ('readings', 'unique'), ('readings', 'non_negative'),
      ('flights', 'has_rows'), ('flights', 'unique')) AS v(s, c)
    UNION ALL SELECT 'readings', 'not_null', 0 FROM range(4)
    UNION ALL SELECT 'flights', 'not_null', 0 FROM range(4)
    UNION ALL SELECT 'readings', 'schema', 0 FROM range({len(READINGS_SCHEMA)})
    UNION ALL SELECT 'flights', 'schema', 0 FROM range({len(FLIGHTS_SCHEMA)})
    """,
)
def checks(spark, sf_dir):
    """Two sources refined, loaded, checked; the stored results, next to the number of rows kept."""
    lake, prefix = shared_folder(spark, "checked-lake"), f"t{uuid.uuid4().hex[:12]}_"
    air = readings(spark, sf_dir)
    time = as_instant(air, "period__datetime_from__utc")
    append_load(air.withColumn("period__datetime_from__utc", time), f"{lake}/bronze/readings", "1", datetime(2026, 1, 1))
    planes = flights(spark, sf_dir)
    planes = planes.withColumn("observed_at", as_instant(planes, "observed_at")).withColumn("ingested_at", F.col("observed_at"))
    write_json_batch(planes.select(*FLIGHTS_SCHEMA.names), f"{lake}/bronze/flights")
    refine(spark, lake, ["readings", "flights"], by_day=False)

    def save(df, name, partition_by=()):
        load_table(df, prefix + name, options={"path": f"{lake}/tables/{name}"}, partition_by=partition_by)

    tables = {s: prefix + t for s, t in load_silver(spark, lake, ["readings", "flights"], save).items()}
    found = spark.table(prefix + check_loaded(spark, tables, save, (READINGS_SOURCE, FLIGHTS_SOURCE)))
    result = found.select("source", "check_name", "failures")
    for source, name in tables.items():
        kept = spark.table(name).agg(F.count(F.lit(1)).alias("failures"))
        result = result.unionByName(kept.select(F.lit(source).alias("source"), F.lit("kept").alias("check_name"), "failures"))
    return result
