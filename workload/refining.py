"""Incremental runs, rejects by reason, stored audit and streamed silver (S4, C6, C7, T5), and the windowed landing."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.operators.aggregation import activity_partials, merged_activity, merged_summary
from skyair.operators.joining import parse_boxes, tag_regions
from skyair.operators.selection import latest
from skyair.plans.landing import land_readings
from skyair.plans.medallion import READINGS, refine, refine_new
from skyair.plans.refining import read_rejects, stored_audit
from skyair.plans.summaries import read_partials, refresh
from skyair.schemas import READINGS as READINGS_SCHEMA
from skyair.sources.readers import read_parquet_declared
from skyair.sources.scratch import shared_folder
from skyair.sources.writers import append_load, load_table, write_snapshot
from skyair.streaming.silver import maintain_silver, read_silver
from workload.plans import TARGETS
from workload.registry import query, rounded
from workload.standins import FLIGHTS, SENSORS, flights, locations, table
from workload.streams import in_batches

#: Ties go to the largest of these, so that SQL can say the same.
SOURCE = replace(READINGS, tiebreak=("value", "parameter", "location_id", "location_name", "country"))

LOADED = """
loaded AS (
  SELECT nullif(user_id % 20, 7) AS sensor_id, date_trunc('hour', ts) AS at_time, nullif(value - 20, 8.0) AS value,
         nullif(event_type, 'error') AS parameter, nullif(user_id % 10, 3) AS location_id,
         'L' || CAST(user_id % 10 AS VARCHAR) AS location_name, 'C' || CAST(user_id % 4 AS VARCHAR) AS country,
         CASE WHEN event_id % 4 < 2 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS load
  FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, at_time
    ORDER BY load DESC, value DESC NULLS LAST, parameter DESC NULLS LAST, location_id DESC NULLS LAST,
             location_name DESC NULLS LAST, country DESC NULLS LAST) AS rn
  FROM loaded),
routed AS (
  SELECT *, CASE WHEN rn > 1 THEN 'duplicate' WHEN value IS NULL OR parameter IS NULL OR location_id IS NULL THEN 'missing'
                 WHEN value < 0 THEN 'out_of_range' ELSE 'kept' END AS reason
  FROM ranked)
"""


def _loads(spark, sf_dir):
    """Events as three loads of hourly readings: all days, then days up to the 20th, then the days after it."""
    events = table(spark, sf_dir, "events")
    time = F.date_trunc("hour", as_instant(events, "ts"))
    late_days = F.dayofmonth("ts") > 20
    return events.select(
        F.nullif(F.col("user_id") % 20, F.lit(7)).alias("sensor_id"),
        time.alias("period__datetime_from__utc"),
        F.nullif(F.col("value") - 20, F.lit(8.0)).alias("value"),
        F.nullif("event_type", F.lit("error")).alias("parameter"),
        F.nullif(F.col("user_id") % 10, F.lit(3)).alias("location_id"),
        F.concat(F.lit("L"), F.col("user_id") % 10).alias("location_name"),
        F.concat(F.lit("C"), F.col("user_id") % 4).alias("country"),
        F.when(F.col("event_id") % 4 < 2, 0).when(late_days, 2).otherwise(1).alias("load"),
    )


def _lake(spark, sf_dir, run, after=lambda lake: None):
    lake, rows = shared_folder(spark, "refined-lake"), _loads(spark, sf_dir)
    for load in range(3):
        own = rows.filter(F.col("load") == load).drop("load")
        append_load(own, f"{lake}/bronze/readings", f"load {load}", datetime(2026, 1, 1) + timedelta(days=load))
        if run is refine_new or load == 2:
            run(spark, lake, ["readings"], sources=[SOURCE])
            after(lake)
    return lake


@query(
    "s4_refine_new",
    f"""
    WITH {LOADED}
    SELECT sensor_id, CAST(at_time AS VARCHAR) AS at_time, value, parameter, location_id, CAST(CAST(at_time AS DATE) AS VARCHAR) AS event_date
    FROM routed WHERE reason = 'kept'
    """,
)
def refine_loads(spark, sf_dir):
    """Refined after each of three loads; the later ones touch some of the days."""
    silver = spark.read.parquet(f"{_lake(spark, sf_dir, refine_new)}/silver/readings")
    return silver.select("sensor_id", F.col("period__datetime_from__utc").alias("at_time"), "value", "parameter", "location_id", "event_date")


@query(
    "c7_rejects",
    f"""
    WITH {LOADED}
    SELECT reason, CAST(CAST(at_time AS DATE) AS VARCHAR) AS event_date, sensor_id, value, parameter, count(*) AS row_count
    FROM routed WHERE reason <> 'kept' GROUP BY ALL
    """,
)
def rejects(spark, sf_dir):
    """What three incremental runs set aside, by reason and day."""
    rows = read_rejects(spark, _lake(spark, sf_dir, refine_new), "readings")
    return rows.groupBy("reason", "event_date", "sensor_id", "value", "parameter").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "c7_stored_audit",
    f"""
    WITH {LOADED}
    SELECT count(*) AS rows_before, count(*) FILTER (reason <> 'duplicate') AS rows_after_dedup,
           count(*) FILTER (reason IN ('kept', 'out_of_range')) AS rows_after_nulls, count(*) FILTER (reason = 'kept') AS rows_after_range
    FROM routed
    """,
)
def counted(spark, sf_dir):
    """The audit of one whole run, counted from what it wrote."""
    return stored_audit(spark, _lake(spark, sf_dir, refine), "readings")


@query(
    "t5_silver_with_late_rows",
    """
    SELECT user_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts, min(event_id % 4) AS arrival, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date
    FROM events WHERE user_id <> 7 GROUP BY user_id, date_trunc('hour', ts), CAST(ts AS DATE)
    """,
)
def late_rows_merged(spark, sf_dir):
    """Four batches, later ones full of late rows, which are merged into their days as they come."""
    _, stream, folder = in_batches(spark, sf_dir, "stream-silver", F.col("event_id"), 4)
    time = F.date_trunc("hour", as_instant(stream, "ts")).alias("ts")
    hourly = stream.select(F.nullif("user_id", F.lit(7)).alias("user_id"), time, "arrival")
    keys = ["user_id", "ts"]
    path = f"{folder}/silver"
    maintain_silver(hourly, path, f"{folder}/checkpoint", keys, "ts", "2 hours", keys, arrival=["arrival"], seconds=None).awaitTermination()
    return read_silver(spark, path)


@query(
    "p_land_backfill",
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
      SELECT user_id * 10 + event_id % 7 + 1 AS sensor_id, date_trunc('second', ts) AS at_time, value FROM events),
    joined AS (
      SELECT m.*, parameter, location_id, location_name, country, row_number() OVER (
        PARTITION BY sensor_id ORDER BY at_time DESC, value DESC) AS rn
      FROM measured m JOIN sensors USING (sensor_id) JOIN places USING (country, location_id)
      WHERE parameter IN {TARGETS} AND at_time >= sensor_last - INTERVAL 7 DAY)
    SELECT sensor_id, CAST(at_time AS VARCHAR) AS at_time, value, parameter, location_id, location_name, country
    FROM joined WHERE rn <= 5
    """,
)
def land_backfill(spark, sf_dir):
    """Measurements in folders by day; each sensor's readings of the week before its own last report."""
    events = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    measured = events.select(
        (F.col("user_id") * 10 + F.col("event_id") % 7 + 1).alias("sensor_id"),
        "value",
        F.struct(F.struct(text.alias("utc")).alias("datetimeFrom")).alias("period"),
        F.to_date("ts").alias("day"),
    )
    folder = shared_folder(spark, "landed-backfill")
    write_snapshot(measured, f"{folder}/measurements", ["day"])
    land_readings(
        locations(spark, sf_dir), spark.read.parquet(f"{folder}/measurements"), f"{folder}/bronze", "week",
        datetime(2026, 1, 1), targets=TARGETS, rows_per_sensor=5, day="day",
    )
    bronze = read_parquet_declared(spark, f"{folder}/bronze", READINGS_SCHEMA)
    return bronze.select(
        "sensor_id", F.col("period__datetime_from__utc").alias("at_time"), "value", "parameter", "location_id", "location_name", "country",
    )


@query(
    "j3_date_line",
    """
    SELECT region, event_id FROM (
      SELECT event_id, user_id % 180 - 90.0 AS lat, event_id % 360 - 180.0 AS lon FROM events)
    JOIN (VALUES ('pacific', -90.0, 150.0, 30.0, -120.0), ('islands', -88.0, 175.0, -80.0, -178.0), ('plain', -90.0, 0.0, 20.0, 20.0))
      AS b(region, lamin, lomin, lamax, lomax)
      ON lat BETWEEN lamin AND lamax
         AND CASE WHEN lomin <= lomax THEN lon BETWEEN lomin AND lomax ELSE lon >= lomin OR lon <= lomax END
    """,
)
def date_line(spark, sf_dir):
    """Boxes that run over the date line."""
    boxes = parse_boxes(spark, "pacific,-90,150,30,-120|islands,-88,175,-80,-178|plain,-90,0,20,20")
    points = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 180 - 90.0).cast("double").alias("latitude"),
        (F.col("event_id") % 360 - 180.0).cast("double").alias("longitude"),
    )
    return tag_regions(points, boxes).select("region", "event_id")


@query(
    "a1_kept_up_to_date",
    f"""
    WITH {LOADED}
    SELECT country, location_id, location_name, parameter, CAST(CAST(at_time AS DATE) AS VARCHAR) AS reading_date,
           count(*) AS reading_count, round(avg(value), 6) AS avg_value, min(value) AS min_value, max(value) AS max_value
    FROM routed WHERE reason = 'kept' GROUP BY ALL
    """,
)
def daily_kept_up(spark, sf_dir):
    """Daily summary from partial rows that were refreshed after each of three loads, for changed days only."""
    lake = _lake(spark, sf_dir, refine_new, after=lambda lake: refresh(spark, lake, "readings"))
    return rounded(merged_summary(read_partials(spark, lake, "readings")), "avg_value")


@query(
    "a5_trend_from_partials",
    f"""
    WITH {LOADED},
    daily AS (SELECT location_id, country, CAST(at_time AS DATE) AS reading_date, parameter, avg(value) AS mean
              FROM routed WHERE reason = 'kept' GROUP BY ALL)
    SELECT parameter, CAST(reading_date AS VARCHAR) AS reading_date, round(avg(mean), 9) AS avg_value FROM daily GROUP BY ALL
    """,
)
def trend_from_partials(spark, sf_dir):
    """Trend of every parameter: means of location-day means, derived from the partial rows of one whole run."""
    lake = _lake(spark, sf_dir, refine, after=lambda lake: refresh(spark, lake, "readings"))
    daily = merged_summary(read_partials(spark, lake, "readings"), ["country", "location_id", "parameter", "reading_date"])
    trend = daily.groupBy("parameter", "reading_date").agg(F.avg("avg_value").alias("avg_value"))
    return rounded(trend, "avg_value", places=9)  # more places than an exact tie has


@query(
    "a3_weekly_aircraft",
    f"""
    WITH {FLIGHTS}
    SELECT country, CAST(CAST(date_trunc('week', reading_date) AS DATE) AS VARCHAR) AS week, true AS within_bound,
           round(avg(baro_altitude), 8) AS avg_altitude
    FROM (SELECT origin_country AS country, CAST(observed_at AS DATE) AS reading_date, baro_altitude FROM flights) GROUP BY ALL
    """,
)
def weekly_aircraft(spark, sf_dir):
    """Weeks out of daily sketches: the distinct aircraft are within 5 % (and a half) of the exact count."""
    planes = flights(spark, sf_dir)
    week = lambda day: F.to_date(F.date_trunc("week", day)).alias("week")
    weekly = merged_activity(activity_partials(planes), ["country", week(F.col("reading_date"))])
    exact = planes.groupBy(F.col("origin_country").alias("country"), week(F.col("observed_at"))).agg(F.countDistinct("icao24").alias("n"))
    both = weekly.join(exact, ["country", "week"], "full")
    near = F.abs(F.col("flight_count") - F.col("n")) <= 0.05 * F.col("n") + 0.5
    return rounded(both.select("country", "week", near.alias("within_bound"), "avg_altitude"), "avg_altitude", places=8)


@query(
    "s6_bucketed_table",
    """
    SELECT o_custkey AS icao24, CAST(max(o_orderdate) AS VARCHAR) AS observed_at, count(*) AS row_count,
           CAST(count(*) - count(DISTINCT o_orderdate) AS BIGINT) AS surplus
    FROM orders GROUP BY o_custkey
    """,
)
def bucketed(spark, sf_dir):
    """A table dealt by aircraft: the latest state (W1) and repeated keys (Q3) of each, without a shuffle."""
    folder, name = shared_folder(spark, "bucketed-table"), f"t{uuid4().hex[:12]}_flights"
    planes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("icao24"), F.col("o_orderdate").alias("observed_at"))
    load_table(planes, name, options={"path": folder}, bucket_by=["icao24"], buckets=8)
    stored = spark.table(name)
    times = stored.groupBy("icao24", "observed_at").agg(F.count(F.lit(1)).alias("n"))
    counts = times.groupBy("icao24").agg(F.sum("n").alias("row_count"), (F.sum("n") - F.count(F.lit(1))).alias("surplus"))
    return latest(stored, ["icao24"], "observed_at").join(counts, "icao24")
