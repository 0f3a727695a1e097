"""Silver and latest state kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Sequence
from time import time_ns

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyair.functions.times import as_instant
from skyair.operators.cleaning import clean, keep_valid, require
from skyair.operators.ranking import spread, tiebreak_columns
from skyair.operators.selection import latest
from skyair.schemas import FLUSH_SECONDS
from skyair.sources.folders import matching, recover, remove
from skyair.sources.writers import write_snapshot
from skyair.streaming.landing import Batches, _triggered

_SALT = "__salt"
STREAM_SALTS = 1
_CHANGES, _SNAPSHOT, _HELD = "changes", "snapshot", "held"
#: How long a replaced snapshot and its batches stay for those who still read them.
GRACE_SECONDS = 3600.0


def clean_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    lateness: str,
    required: Sequence[str],
    valid: Column | None = None,
    validate_first: bool = False,
    salts: int = STREAM_SALTS,
) -> DataFrame:
    """T5: cleaning as in C6, incrementally; the first copy of a key to arrive is the one kept.

    ``time`` must be one of the keys, so that state older than the watermark (``lateness`` behind the
    newest event) is dropped exactly. Rows later than that do not reach the result: ``late_rows`` finds them
    in bronze, and appending them makes silver equal to the batch form (``silver.maintain_silver`` does
    both as it goes, reading no bronze). The dedup runs first per key
    and salt, then per key, so copies of one key arriving over many input partitions do not all go to
    one task. ``salts=1`` turns that off.
    """
    if time not in keys:
        raise ValueError(f"the event time {time!r} has to be one of the keys {list(keys)}")
    rows = stream.withColumn(time, as_instant(stream, time)).withWatermark(time, lateness)

    def filtered(df: DataFrame) -> DataFrame:
        df = require(df, required)
        return df if valid is None else keep_valid(df, valid)

    if validate_first:
        rows = filtered(rows)
    if salts > 1:
        rows = rows.withColumn(_SALT, spread(rows, salts, keys)).dropDuplicates([*keys, _SALT]).drop(_SALT)
    rows = rows.dropDuplicates(list(keys))
    return rows if validate_first else filtered(rows)


def latest_stream(stream: DataFrame, key: str, time: str) -> DataFrame:
    """The latest row per key as a streaming aggregate (window functions need a finite input).

    The maximum of (time, all other columns) picks the row that ``selection.latest`` would; columns
    that have no order, such as maps, go with it. It combines on the map side, and its state is one row
    per key.
    """
    order = F.struct(time, *tiebreak_columns(stream, [key, time]))
    row = F.struct(*(name for name in stream.columns if name != key))
    newest = F.max_by(row, order).alias("__newest")
    columns = [F.col(key) if name == key else F.col(f"__newest.{name}") for name in stream.columns]
    return stream.groupBy(key).agg(newest).select(*columns)


def maintain_latest(
    stream: DataFrame, key: str, time: str, path: str, checkpoint: str, seconds: int | None = FLUSH_SECONDS
) -> StreamingQuery:
    """Write the keys each batch changed below ``path``; ``read_latest`` merges them.

    A replayed batch replaces its own folder, and another checkpoint writes below another query id. Only
    changed keys are written, never the whole table.
    """

    batches = Batches(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batches.folder(batch.sparkSession, f"{path}/{_CHANGES}", batch_id))

    writer = latest_stream(stream, key, time).writeStream.outputMode("update").foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), seconds).start()


def _snapshots(spark: SparkSession, path: str) -> tuple[str | None, dict[str, int]]:
    """The newest finished snapshot and the last batch of each query it holds.

    The list of batches is written after the snapshot's rows, so an unfinished snapshot has none.
    """
    recover(spark, f"{path}/{_HELD}")
    try:
        done = spark.read.parquet(f"{path}/{_HELD}")
    except AnalysisException:
        return None, {}
    newest = done.agg(F.max("snapshot")).first()[0]
    held = {r["query_id"]: r["batch_id"] for r in done.filter(F.col("snapshot") == newest).collect()}
    return f"{path}/{_SNAPSHOT}/{newest}", held


def read_latest(spark: SparkSession, path: str, key: str, time: str) -> DataFrame:
    """The current latest row per key: the newest snapshot and the batches after it."""
    snapshot, held = _snapshots(spark, path)
    rows = spark.read.parquet(f"{path}/{_CHANGES}")
    for query, batch in held.items():  # one entry per query; whole folders are pruned
        rows = rows.filter((F.col("query_id") != query) | (F.col("batch_id") > batch))
    rows = rows.drop("query_id", "batch_id")
    if snapshot:
        rows = rows.unionByName(spark.read.parquet(snapshot), allowMissingColumns=True)
    return latest(rows, [key], time)


def compact_latest(spark: SparkSession, path: str, key: str, time: str, grace_seconds: float = GRACE_SECONDS) -> None:
    """Write the latest rows as a snapshot, from which readers start, and delete what it has replaced.

    The last batch of each query is left out, because it may still be written or replayed. The merge is a
    maximum, so a batch that is both in the snapshot and read again changes nothing. Deleting takes two
    steps: a snapshot and the batches in it go with a later compaction, once there is a newer snapshot and
    the grace time for those who may still read the old one is over. So the log holds the batches of about
    two compactions and of the grace time, however long the query runs.
    """
    last = (
        spark.read.parquet(f"{path}/{_CHANGES}")
        .groupBy("query_id")
        .agg((F.max("batch_id") - 1).cast("bigint").alias("batch_id"))
        .filter("batch_id >= 0")
    )
    held = {r["query_id"]: r["batch_id"] for r in last.collect()}
    if not held:
        return
    name = f"{time_ns():020d}"
    rows = spark.read.parquet(f"{path}/{_CHANGES}")
    own = F.lit(False)
    for query, batch in held.items():
        own = own | ((F.col("query_id") == query) & (F.col("batch_id") <= batch))
    rows = rows.filter(own).drop("query_id", "batch_id")
    snapshot, _ = _snapshots(spark, path)
    if snapshot:
        rows = rows.unionByName(spark.read.parquet(snapshot), allowMissingColumns=True)
    latest(rows, [key], time).write.parquet(f"{path}/{_SNAPSHOT}/{name}")
    listed = spark.createDataFrame([(name, q, b) for q, b in held.items()], "snapshot string, query_id string, batch_id bigint")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/{_HELD}")
    _delete_replaced(spark, path, grace_seconds)


def _delete_replaced(spark: SparkSession, path: str, grace_seconds: float) -> None:
    """Delete the snapshots before the newest that are older than the grace time, and the batches in them."""
    done = spark.read.parquet(f"{path}/{_HELD}").collect()  # one row per snapshot that is left and query
    newest = max(row.snapshot for row in done)
    limit = time_ns() - grace_seconds * 1e9
    old = [row for row in done if row.snapshot < newest and int(row.snapshot) <= limit]
    for row in old:
        for folder in matching(spark, f"{path}/{_CHANGES}/query_id={row.query_id}/batch_id=*"):
            if int(folder.rpartition("=")[2]) <= row.batch_id:
                remove(spark, folder)
    for name in {row.snapshot for row in old}:
        remove(spark, f"{path}/{_SNAPSHOT}/{name}")
    if old:
        left = spark.createDataFrame([row for row in done if row not in old], "snapshot string, query_id string, batch_id bigint")
        write_snapshot(left.coalesce(1), f"{path}/{_HELD}")


def late_rows(
    bronze: DataFrame,
    silver: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    required: Sequence[str],
    valid: Column | None = None,
    validate_first: bool = False,
) -> DataFrame:
    """T5: cleaned rows of bronze whose key is not in silver, the first to arrive of each key.

    With them silver holds what the batch form gives, however late a row came. Keys are compared null-safe.
    """
    whole = clean(bronze, keys, required, valid, arrival, keep_first=True, validate_first=validate_first)
    known = silver.select(*(F.col(k).alias(f"__known_{k}") for k in keys)).distinct()
    same = [whole[k].eqNullSafe(known[f"__known_{k}"]) for k in keys]
    return whole.join(known, same, "left_anti")
