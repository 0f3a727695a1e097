"""Landing a stream as bronze files."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skyair.operators.joining import place_boxes, tag_regions
from skyair.operators.shaping import parse_payloads, states_of
from skyair.schemas import FLUSH_SECONDS
from skyair.sources.writers import JSON_OPTIONS


def _triggered(writer: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """Every ``seconds``; 0 leaves it to the source; None takes all that is available and stops."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query behind a checkpoint: the same after every restart, another for every checkpoint."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


class Batches:
    """Names of the batches of the query behind a checkpoint; its id is read once."""

    def __init__(self, checkpoint: str) -> None:
        self.checkpoint, self.id = checkpoint, None

    def query(self, spark: SparkSession) -> str:
        if self.id is None:  # the first batch: the query has written its id by then
            self.id = query_id(spark, self.checkpoint)
        return self.id

    def folder(self, spark: SparkSession, path: str, batch_id: int) -> str:
        """Where a batch is written: two queries on one path never meet, a replayed batch meets itself."""
        return f"{path}/query_id={self.query(spark)}/batch_id={batch_id}"


def land(
    records: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "json",
    seconds: int | None = FLUSH_SECONDS,
    max_records_per_file: int = 0,
) -> StreamingQuery:
    """Append micro-batches to ``path``; a restart with the same checkpoint resumes exactly.

    Offsets and files are committed together, so a crash neither loses nor repeats records. For a topic
    pass ``seconds=0``: its source then begins a batch at the record minimum or after the delay, whichever
    comes first (``topics.source_options``); a trigger interval on top could only hold a batch back. ``max_records_per_file`` bounds
    the file size; 0 leaves it to the trigger, which at high rates avoids a flood of small files.
    """
    options = JSON_OPTIONS if format == "json" else {}
    writer = records.writeStream.format(format).options(**options).outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer.option("maxRecordsPerFile", max_records_per_file), seconds).start(path)


def land_states(
    payloads: DataFrame,
    path: str,
    quarantine: str,
    checkpoint: str,
    payload: str = "value",
    keep: tuple[str, ...] = (),
    boxes: DataFrame | None = None,
    seconds: int | None = FLUSH_SECONDS,
) -> StreamingQuery:
    """T4: state records to ``path``; payloads that do not parse to ``quarantine``; the stream lives on.

    With ``boxes`` the records are tagged with their regions, as in ``states.parse_states``. Each batch
    writes a folder of its own below the query's id and replaces it when replayed, so a batch repeated after a
    failure leaves no duplicates and another checkpoint on the same path replaces nothing. Read either
    folder as one table.
    """
    placed = None if boxes is None else place_boxes(boxes)
    batches = Batches(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parse_payloads(batch, payload).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = states_of(parsed, keep)
            if placed is not None:
                good = tag_regions(good, placed)
            bad = parsed.filter("NOT well_formed").drop("parsed", "well_formed")
            good.write.mode("overwrite").options(**JSON_OPTIONS).json(batches.folder(spark, path, batch_id))
            bad.write.mode("overwrite").json(batches.folder(spark, quarantine, batch_id))
        finally:
            parsed.unpersist()

    writer = payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, seconds).start()
