"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.sources.folders import publish, staged_beside

# Spark's default for JSON text drops everything below the millisecond. Fixed formats; readers need none.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Afterwards ``path`` holds exactly the rows of ``df`` as parquet, also if there are none.

    The rows are written beside ``path`` and take its place when the job has ended, so a job that dies
    leaves the old snapshot. ``df`` may read ``path`` itself. With ``partition_by`` the rows are rebalanced
    on those columns: each value lands in few files of fair size, and a value with many rows is split
    over several tasks.
    """
    staged = staged_beside(path)
    write_staged(df, staged, partition_by)
    publish(df.sparkSession, staged, path)


def write_staged(df: DataFrame, path: str, partition_by: Sequence[str] = (), balanced: bool = True) -> None:
    """The files of a snapshot, which replace whatever an earlier job left at ``path``.

    Where ``partition_by`` has a handful of values, ``balanced=False`` saves the shuffle: a task then writes one
    file for each of them.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    rows = df.hint("rebalance", *map(F.col, partition_by)) if balanced else df
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static").parquet(path)
    if df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        # A partitioned write of no rows leaves no file, so nothing that could be read as a table.
        df.limit(0).write.mode("overwrite").parquet(path)


def load_table(
    df: DataFrame,
    table: str,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Replace a warehouse table by the rows of ``df``. Other warehouses by ``format`` and options.

    With ``partition_by`` the rows are rebalanced on those columns, as in ``write_snapshot``. With
    ``bucket_by`` the table is dealt by key into ``buckets`` sorted files, so that what groups or ranks by
    these keys reads it without a shuffle. All rows of a key are in one bucket: see ``evenly_keyed``.
    """
    if partition_by:
        df = df.hint("rebalance", *map(F.col, partition_by))
    elif bucket_by:
        df = df.repartition(buckets, *bucket_by)  # as the buckets are dealt, so a task writes one of them
    writer = df.write.format(format).options(**(options or {})).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    elif bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)


def evenly_keyed(df: DataFrame, keys: Sequence[str], buckets: int) -> bool:
    """Whether no key holds more than two buckets' fair share of the rows, so that buckets by key stay even.

    Counts combine on the map side, so a hot key costs no more than others.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = counts.agg(F.max("n"), F.sum("n")).first()
    return rows is None or largest * buckets <= 2 * rows


def with_lineage(df: DataFrame, load_id: str, loaded_at: datetime | None = None) -> DataFrame:
    """Stamp rows with the load's id, its time and a unique row id.

    The time (default: now) tells which load is newer; the id is only lineage, and need not sort. A row id is
    the load's own token and the row's number, which stays the same in a task that is run again and is stored in
    a third of the room of a random id per row.
    """
    moment = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    stamped = df.withColumn("_load_id", F.lit(load_id)).withColumn("_load_time", moment.cast("timestamp"))
    return stamped.withColumn("_row_id", F.concat_ws("-", F.lit(uuid4().hex), F.monotonically_increasing_id().cast("string")))


def append_load(df: DataFrame, path: str, load_id: str, loaded_at: datetime | None = None) -> None:
    """Append a load to a bronze table. Copies of one record are resolved later, by cleaning."""
    with_lineage(df, load_id, loaded_at).write.mode("append").parquet(path)


def write_json_batch(df: DataFrame, path: str) -> bool:
    """Append a batch as JSON-lines; writes nothing and returns False if there are no rows."""
    if df.isEmpty():
        return False
    df.write.mode("append").options(**JSON_OPTIONS).json(path)
    return True
