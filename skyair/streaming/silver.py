"""Silver kept up to date from a stream, rows behind the watermark included (T5).

Each batch is written once, every row under its reason: kept, or why not. Rows behind the watermark, which
the state can no longer judge, go to a side output of the same write (``late``). They are then merged into the
event days they touch: what is known of these days, and of no other, tells which of their keys are new.
Keys hold the event time, so all copies of a key are of one day.

    <path>/reason=kept|missing|out_of_range|late/event_date=<day>/batch=<query>-<number>[-late]

A replayed batch replaces its own folders. One query writes to a path.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyair.functions.times import as_instant, utc_day
from skyair.operators.cleaning import KEPT, MISSING, OUT_OF_RANGE, REASON, dedup_first, fault_of
from skyair.operators.ranking import spread
from skyair.schemas import FLUSH_SECONDS
from skyair.sources.folders import matching
from skyair.streaming.incremental import STREAM_SALTS
from skyair.streaming.landing import Batches, _triggered

LATE = "late"
EVENT_DATE, BATCH = "event_date", "batch"
_RAW, _SALT = "__raw", "__salt"
#: Into how many files a batch deals the rows of a day and reason at most, and so how many tasks share them.
DAY_FILES = 16
#: What counts as known when late rows are merged. A key whose first copy was bad stays lost, as in C6.
_KNOWN = (KEPT, MISSING, OUT_OF_RANGE)


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark a batch runs with, in milliseconds, from the checkpoint: the same when it is replayed."""
    _, settings, *_ = (row.value for row in spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}").collect())
    return json.loads(settings)["batchWatermarkMs"]


def _write(rows: DataFrame, path: str, batch: str) -> None:
    # A day's rows come out of every state partition: dealt by day, they are a few files and not one of each.
    # Adaptive execution, which would rebalance them, is off in the session of a stateful stream.
    rows = rows.withColumn(_SALT, spread(rows, DAY_FILES)).repartition(REASON, EVENT_DATE, _SALT).drop(_SALT)
    labelled = rows.withColumn(BATCH, F.lit(batch))
    writer = labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(REASON, EVENT_DATE, BATCH).parquet(path)


def touched_days(spark: SparkSession, path: str, batch: str) -> list[str]:
    """Day folders (``event_date=...``) that the late rows of a batch belong to; names only, nothing is read."""
    return [found.split("/")[-2] for found in matching(spark, f"{path}/{REASON}={LATE}/*/{BATCH}={batch}")]


def merge_late(
    spark: SparkSession, path: str, batch: str, keys: Sequence[str], arrival: Sequence[str], required: Sequence[str],
    valid: Column | None = None, validate_first: bool = False,
) -> DataFrame | None:
    """The late rows of a batch that are new to their days, each with its reason; None if none was late.

    Of each key the first by ``arrival`` counts. With ``validate_first`` bad copies do not compete.
    """
    days = touched_days(spark, path, batch)
    if not days:
        return None
    reader = spark.read.option("basePath", path)
    late = reader.parquet(*(f"{path}/{REASON}={LATE}/{day}/{BATCH}={batch}" for day in days)).drop(REASON, BATCH)
    fault = fault_of(late, required, valid)
    if validate_first:
        late = late.filter(fault.isNull())
    first = dedup_first(late, keys, arrival).withColumn(REASON, F.coalesce(fault, F.lit(KEPT)))
    reasons = (KEPT,) if validate_first else _KNOWN
    folders = [f for day in days for reason in reasons for f in matching(spark, f"{path}/{REASON}={reason}/{day}")]
    if not folders:
        return first
    # Not what an earlier try of this very merge has written: it is replaced.
    known = reader.parquet(*folders).filter(F.col(BATCH) != f"{batch}-{LATE}")
    known = known.select(*(F.col(k).alias(f"__known_{k}") for k in keys))
    return first.join(known, [first[k].eqNullSafe(known[f"__known_{k}"]) for k in keys], "left_anti")


def maintain_silver(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    lateness: str,
    required: Sequence[str],
    valid: Column | None = None,
    arrival: Sequence[str] = (),
    validate_first: bool = False,
    salts: int = STREAM_SALTS,
    seconds: int | None = FLUSH_SECONDS,
) -> StreamingQuery:
    """T5: clean a stream into ``path``, the first copy of a key to arrive being the one that counts.

    On time, copies are found in the query's state, which holds what lies within ``lateness`` of the newest
    event. Later rows are merged as they come, so that silver equals the batch form (C6, keep first) however
    late a row is. ``arrival`` orders late copies that come in one batch. Read with ``read_silver``.
    """
    if time not in keys:
        raise ValueError(f"the event time {time!r} has to be one of the keys {list(keys)}")
    rows = stream.withColumn(time, as_instant(stream, time))
    rows = rows.withColumn(REASON, F.coalesce(fault_of(rows, required, valid), F.lit(KEPT)))
    judged = rows.withWatermark(time, lateness)
    if validate_first:
        judged = judged.filter(F.col(REASON) == KEPT)
    if salts > 1:
        judged = judged.withColumn(_SALT, spread(rows, salts, keys)).dropDuplicates([*keys, _SALT]).drop(_SALT)
    judged = judged.dropDuplicates(list(keys))
    both = judged.withColumn(_RAW, F.lit(False)).unionByName(rows.withColumn(_RAW, F.lit(True)))
    batches = Batches(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{batches.query(spark)}-{batch_id}"
        # State lets a row at the watermark go too. A row that it did judge may be merged as well: it is known then.
        behind = F.col(time) <= F.timestamp_millis(F.lit(watermark_of(spark, checkpoint, batch_id)))
        bad = F.col(REASON) != KEPT if validate_first else F.lit(False)
        reason = F.when(~F.col(_RAW) | bad, F.col(REASON)).when(behind, LATE)
        routed = batch.withColumn(REASON, reason).filter(F.col(REASON).isNotNull()).drop(_RAW)
        _write(routed.withColumn(EVENT_DATE, utc_day(routed, time)), path, name)
        found = merge_late(spark, path, name, keys, arrival, required, valid, validate_first)
        if found is not None:
            _write(found, path, f"{name}-{LATE}")

    writer = both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, seconds).start()


def read_silver(spark: SparkSession, path: str, reason: str = KEPT) -> DataFrame:
    """The rows kept so far, or those of another reason; ``event_date`` prunes."""
    return spark.read.parquet(path).filter(F.col(REASON) == reason).drop(REASON, BATCH)
