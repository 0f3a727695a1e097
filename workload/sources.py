"""Each writes whole tables to the shared folder and reads them back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.plans.marts import daily_summary
from skyair.operators.cleaning import dedup_newest
from skyair.plans.medallion import build
from skyair.plans.models import Model, build_models
from skyair.schemas import FLIGHTS as FLIGHTS_SCHEMA
from skyair.sources.readers import optional, read_json_lines, read_parquet_files, split_corrupt
from skyair.sources.scratch import shared_folder
from skyair.sources.topics import decode, encode
from skyair.sources.writers import append_load, load_table, write_json_batch, write_snapshot
from workload.marts import DAILY
from workload.registry import query
from workload.standins import FLIGHTS, READINGS, flights, readings, table

_EVENTS = "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events"


@query("s1_json_lines", _EVENTS)
def s1(spark, sf_dir):
    """Every error event is followed by a blank line and a line cut short, which have to stay out of the good rows."""
    events = table(spark, sf_dir, "events")
    folder = shared_folder(spark, "json-lines")
    line = F.col("value")
    spoiled = F.when(line.contains("error"), F.array(line, F.lit(""), F.substring(line, 1, 20)))
    lines = encode(events).select(F.explode(F.coalesce(spoiled, F.array(line))))
    lines.write.text(folder)
    good, _ = split_corrupt(read_json_lines(spark, folder, events.schema))
    return good


@query("s2_parquet_files", "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem")
def s2(spark, sf_dir):
    """Part files, four or one per split of the table if it has more, and a stray text file in one folder."""
    folder = shared_folder(spark, "parquet-files")
    items = table(spark, sf_dir, "lineitem")
    items.repartition(max(4, items.rdd.getNumPartitions())).write.parquet(folder)
    spark.range(3).select(F.col("id").cast("string")).write.mode("append").text(folder)
    return read_parquet_files(spark, folder)


@query("s3_optional_source", "SELECT n_regionkey, count(*) AS nations, 1 AS sources_read FROM nation GROUP BY ALL")
def s3(spark, sf_dir):
    """One of two sources is absent; the other is still processed."""
    frames = [
        optional(lambda: table(spark, sf_dir, "nation"), "nation"),
        optional(lambda: table(spark, sf_dir, "no_such_table"), "no_such_table"),
    ]
    present = [frame for frame in frames if frame is not None]
    counts = present[0].groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    return counts.withColumn("sources_read", F.lit(len(present)))


@query("s5_snapshot", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders WHERE o_orderstatus <> 'P'")
def s5(spark, sf_dir):
    """The second, smaller snapshot replaces the first one, partitions included."""
    orders = table(spark, sf_dir, "orders")
    folder = shared_folder(spark, "snapshot")
    write_snapshot(orders, folder, ["o_orderstatus"])
    write_snapshot(orders.filter("o_orderstatus <> 'P'"), folder, ["o_orderstatus"])
    return read_parquet_files(spark, folder, orders.schema)


def _table_saver(spark, prefix):
    """Tables under names and folders of their own, so that runs do not meet."""
    folder = shared_folder(spark, "warehouse")

    def save(df, name, partition_by=()):
        load_table(df, prefix + name, options={"path": f"{folder}/{name}"}, partition_by=partition_by)

    return save


def _prefix():
    return f"t{uuid.uuid4().hex[:12]}_"


@query("s6_table_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def s6(spark, sf_dir):
    prefix = _prefix()
    save = _table_saver(spark, prefix)
    customers = table(spark, sf_dir, "customer")
    save(customers, "customer")
    save(customers.filter("c_acctbal >= 0"), "customer")
    return spark.table(prefix + "customer")


@query(
    "s7_append_load",
    """
    SELECT user_id, load AS _load_id, count(*) AS row_count, count(*) AS row_ids
    FROM events, (SELECT unnest(['first', 'second']) AS load) WHERE load = 'first' OR event_id % 2 = 0 GROUP BY ALL
    """,
)
def s7(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    folder = shared_folder(spark, "append-load")
    append_load(events, folder, "first")
    append_load(events.filter("event_id % 2 = 0"), folder, "second")
    loads = read_parquet_files(spark, folder).groupBy("user_id", "_load_id")
    return loads.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("_row_id").alias("row_ids"))


@query(
    "s7_newest_load",
    """
    SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN '10' ELSE '9' END AS _load_id,
           CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value
    FROM events
    """,
)
def s7_newest(spark, sf_dir):
    """Load "10" is newer than load "9", although its id sorts before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    folder = shared_folder(spark, "newest-load")
    append_load(events, folder, "9", datetime(2026, 1, 1))
    again = events.filter("event_id % 3 = 0").withColumn("value", F.col("value") + 1)
    append_load(again, folder, "10", datetime(2026, 1, 2))
    rows = read_parquet_files(spark, folder)
    newest = dedup_newest(rows, ["event_id"], ["_load_time"], ["_load_id", "_row_id"])
    return newest.select("event_id", "user_id", "_load_id", "value")


@query("s8_json_batch", _EVENTS)
def s8(spark, sf_dir):
    """Two batches and an empty one, which must not be written."""
    events = table(spark, sf_dir, "events")
    folder = shared_folder(spark, "json-batch")
    for part in (events.filter("user_id % 2 = 0"), events.filter("user_id < -1"), events.filter("user_id % 2 = 1")):
        write_json_batch(part, folder)
    return spark.read.schema(events.schema).json(folder)


@query("s9_topic_records", _EVENTS)
def s9(spark, sf_dir):
    """Records to topic values and back; the connector itself is not needed for it."""
    events = table(spark, sf_dir, "events")
    return decode(encode(events), events.schema)


@query(
    "s10_models",
    f"""
    WITH {READINGS}, {DAILY}
    SELECT country, count(*) AS days, sum(reading_count)::BIGINT AS readings FROM daily GROUP BY ALL
    """,
)
def s10(spark, sf_dir):
    """Staging as a view, marts as stored tables; a later mart reads an earlier one; one group is off."""
    prefix = _prefix()
    staging, daily, totals = (prefix + name for name in ("staging", "daily", "totals"))

    def summarise(find):
        return daily_summary(find(staging))

    def total(find):
        by_country = find(daily).groupBy("country")
        return by_country.agg(F.count(F.lit(1)).alias("days"), F.sum("reading_count").alias("readings"))

    models = (
        Model(daily, "batch", summarise, (staging,)),
        Model(totals, "batch", total, (daily,)),
        Model(prefix + "off", "streaming", total, (daily,)),
    )
    folder = shared_folder(spark, "models")

    def save(df, name):
        load_table(df, name, options={"path": f"{folder}/{name}"})

    built = build_models(spark, {staging: readings(spark, sf_dir)}, save, ["batch"], models)
    return spark.table(built[-1])


@query(
    "s4_bronze_to_marts",
    f"""
    WITH {FLIGHTS}
    SELECT icao24, CAST(observed_at AS VARCHAR) AS observed_at, origin_country, baro_altitude
    FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, region DESC,
                 baro_altitude DESC) AS rn
          FROM flights WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
    WHERE rn = 1
    """,
)
def s4(spark, sf_dir):
    """The whole flow for one chosen source: bronze JSON, silver snapshot, table, latest-state mart.

    One customer may place two orders on a day; the order then decides which one is newest.
    """
    lake = shared_folder(spark, "lake")
    bronze = flights(spark, sf_dir)
    bronze = bronze.withColumn("observed_at", as_instant(bronze, "observed_at"))
    stamped = bronze.withColumn("ingested_at", F.timestamp_millis(F.col("baro_altitude").cast("bigint")))
    write_json_batch(stamped.select(*FLIGHTS_SCHEMA.names), f"{lake}/bronze/flights")
    prefix = _prefix()
    save = _table_saver(spark, prefix)
    tables = {}

    def save_named(df, name, partition_by=()):
        save(df, name, partition_by)
        tables[name] = prefix + name
        spark.table(tables[name]).createOrReplaceTempView(name)

    build(spark, lake, ["flights"], ["streaming"], save_named, by_day=False)
    latest = spark.table(tables["latest_states"])
    return latest.select("icao24", "observed_at", "origin_country", "baro_altitude")
