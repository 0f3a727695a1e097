"""T1-T6 over the events table as a file stream, each run to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.operators.joining import parse_boxes
from skyair.sources.scratch import shared_folder
from skyair.streaming.incremental import clean_stream, compact_latest, late_rows, maintain_latest, read_latest
from skyair.streaming.landing import land, land_states
from skyair.streaming.states import parse_states
from workload.registry import query
from workload.standins import payloads, table


def event_stream(spark, sf_dir, name="events"):
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


BOXES = "low, -90, 0, 0, 25 | wide, -90, -180, 90, 180"


@query(
    "t1_stream_states",
    """
    WITH sound AS (SELECT *, to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS at_time FROM events WHERE event_type <> 'error'),
    states AS (
      SELECT event_id, CAST(user_id AS VARCHAR) AS icao24, event_type AS callsign, value AS longitude,
             -12.5::DOUBLE AS latitude, CAST(at_time AS VARCHAR) AS observed_at FROM sound
      UNION ALL SELECT event_id, 'x' || user_id, NULL, 3.5, 4.5, CAST(at_time AS VARCHAR) FROM sound)
    SELECT 'low' AS region, * FROM states WHERE latitude <= 0 AND longitude BETWEEN 0 AND 25
    UNION ALL SELECT 'wide', * FROM states WHERE longitude BETWEEN -180 AND 180
    """,
)
def t1(spark, sf_dir):
    folder = shared_folder(spark, "stream-states")
    raw = payloads(event_stream(spark, sf_dir))
    records = parse_states(raw, parse_boxes(spark, BOXES), keep=["event_id"])
    records = records.select("region", "event_id", "icao24", "callsign", "longitude", "latitude", "observed_at")
    land(records, f"{folder}/data", f"{folder}/checkpoint", "parquet", seconds=None).awaitTermination()
    return spark.read.parquet(f"{folder}/data")


@query("t2_t3_land_and_resume", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events")
def t2(spark, sf_dir):
    """Landed twice with one checkpoint: the second run finds nothing new."""
    folder = shared_folder(spark, "stream-landing")
    for _ in range(2):
        stream = event_stream(spark, sf_dir)
        land(stream, f"{folder}/data", f"{folder}/checkpoint", seconds=None, max_records_per_file=500).awaitTermination()
    return spark.read.schema(table(spark, sf_dir, "events").schema).json(f"{folder}/data")


@query(
    "t4_quarantine",
    """
    SELECT event_type = 'error' AS quarantined, event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END::BIGINT AS row_count
    FROM events
    """,
)
def t4(spark, sf_dir):
    """Two sources, each with a checkpoint of its own, land on one path."""
    folder = shared_folder(spark, "stream-quarantine")
    raw = payloads(event_stream(spark, sf_dir))
    good, bad = f"{folder}/states", f"{folder}/quarantine"
    for name, part in (("even", "event_id % 2 = 0"), ("odd", "event_id % 2 = 1")):
        land_states(raw.filter(part), good, bad, f"{folder}/{name}", keep=("event_id",), seconds=None).awaitTermination()
    landed = spark.read.schema("event_id bigint, icao24 string").json(good)
    rejected = spark.read.schema("event_id bigint, value string").json(bad)
    both = landed.select("event_id", F.lit(False).alias("quarantined")).union(rejected.select("event_id", F.lit(True)))
    return both.groupBy("event_id", "quarantined").agg(F.count(F.lit(1)).alias("row_count"))


ROWS_PER_FILE = 500_000


def in_batches(spark, sf_dir, name, order, count):
    """Events written in ``count`` loads by ``order``, and a stream that takes one load per batch.

    All loads have the same number of files, one per ROWS_PER_FILE rows of the smallest load.
    """
    events = table(spark, sf_dir, "events")
    folder = f"{shared_folder(spark, name)}/input"
    ranked = events.withColumn("arrival", F.pmod(order, F.lit(count)).cast("bigint"))
    sizes = dict(ranked.groupBy("arrival").count().collect())  # one row per load
    files = max(1, min(sizes.get(k, 0) for k in range(count)) // ROWS_PER_FILE)
    for k in range(count):
        load = ranked.filter(F.col("arrival") == k)
        load = load.coalesce(1) if files == 1 else load.repartition(files)
        load.write.mode("append").parquet(folder)
    schema = ranked.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(folder)
    return spark.read.schema(schema).parquet(folder), stream, folder.removesuffix("/input")


@query(
    "t5_clean_stream",
    """
    SELECT user_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts, min(event_id % 4) AS arrival
    FROM events WHERE user_id <> 7 GROUP BY ALL
    """,
)
def t5(spark, sf_dir):
    """Four batches, later ones full of late rows: the stream and the repair from bronze give the first copy of each key."""
    bronze, stream, folder = in_batches(spark, sf_dir, "stream-clean", F.col("event_id"), 4)

    def hourly(rows):
        time = F.date_trunc("hour", as_instant(rows, "ts")).alias("ts")
        return rows.select(F.nullif("user_id", F.lit(7)).alias("user_id"), time, "arrival")

    keys = ["user_id", "ts"]
    cleaned = clean_stream(hourly(stream), keys, "ts", "2 hours", keys)
    land(cleaned, f"{folder}/data", f"{folder}/checkpoint", "parquet", seconds=None).awaitTermination()
    silver = spark.read.parquet(f"{folder}/data")
    return silver.unionByName(late_rows(hourly(bronze), silver, keys, ["arrival"], keys))


@query(
    "t6_latest_stream",
    """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def t6(spark, sf_dir):
    """Two sources on one path, each in several batches, with a compaction in between."""
    _, stream, folder = in_batches(spark, sf_dir, "stream-latest", F.col("event_id"), 4)
    stream = stream.select("event_id", "ts", "user_id", "event_type", "value", "props")
    path = f"{folder}/data"
    for name, part in (("low", "event_id % 3 = 0"), ("high", "event_id % 3 <> 0")):
        maintain_latest(stream.filter(part), "user_id", "ts", path, f"{folder}/{name}", seconds=None).awaitTermination()
        compact_latest(spark, path, "user_id", "ts")
    return read_latest(spark, path, "user_id", "ts")
