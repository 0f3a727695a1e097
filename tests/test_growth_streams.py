"""What must not grow faster than the input: files of a streamed day, tasks that write a load."""

from pyspark.sql import functions as F

from skyair.operators.cleaning import REASON
from skyair.streaming import silver
from workload import streams


def events(spark, folder, n=400):
    at = F.timestamp_seconds(F.lit(1767225600) + F.col("id") * 3600)
    rows = spark.range(n).select(F.col("id").alias("event_id"), at.cast("timestamp_ntz").alias("ts"), (F.col("id") % 9).alias("user_id"))
    rows.write.parquet(f"{folder}/events.parquet")


def test_a_load_of_several_files_is_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 30)
    events(spark, tmp_path)
    bronze, stream, folder = streams.in_batches(spark, str(tmp_path), "growth", F.col("event_id"), 4)
    seen = []
    note = lambda batch, number: seen.append(sorted(map(tuple, batch.groupBy("arrival").count().collect())))
    stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    assert len(bronze.inputFiles()) == 12 and seen == [[(k, 100)] for k in range(4)]


def test_a_streamed_day_is_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(silver, "DAY_FILES", 1)
    events(spark, tmp_path)
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/events.parquet").schema).parquet(f"{tmp_path}/events.parquet")
    path = f"{tmp_path}/silver"
    args = (path, f"{tmp_path}/checkpoint", ["user_id", "ts"], "ts", "2 hours", ["user_id"])
    silver.maintain_silver(stream, *args, seconds=None).awaitTermination()
    rows = spark.read.parquet(path)
    days = rows.select(REASON, "event_date", "batch").distinct().count()
    assert (rows.count(), len(rows.inputFiles())) == (400, days)
