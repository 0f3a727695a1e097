"""Topics of JSON records.

The Kafka connector is a separate Spark package. Encoding and decoding are kept apart from it, so any
source that delivers a ``value`` column can stand in.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from skyair.schemas import FLUSH_RECORDS, FLUSH_SECONDS
from skyair.sources.writers import JSON_OPTIONS


def source_options(
    servers: str, topic: str, min_records: int = FLUSH_RECORDS, max_delay_seconds: int = FLUSH_SECONDS
) -> dict[str, str]:
    """Start from the earliest offset; a batch begins at ``min_records`` or after the delay, whichever
    comes first. There is no upper bound per batch: a backlog is taken in one go, over all partitions."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(min_records),
        "maxTriggerDelay": f"{max_delay_seconds}s",
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **limits: int) -> DataFrame:
    """Stream of a topic's values as text, column ``value``."""
    stream = spark.readStream.format("kafka").options(**source_options(servers, topic, **limits)).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def write_topic(
    records: DataFrame, servers: str, topic: str, checkpoint: str, options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """Writer of a record stream to a topic, one JSON value per record."""
    sink = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return encode(records).writeStream.format("kafka").options(**sink, **(options or {}))


def encode(records: DataFrame) -> DataFrame:
    """Records to a ``value`` column of JSON text, null fields included."""
    whole = F.struct(*(F.col(name) for name in records.columns))
    return records.select(F.to_json(whole, {"ignoreNullFields": "false", **JSON_OPTIONS}).alias("value"))


def decode(values: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text back to typed records; text that does not parse gives a record of nulls."""
    return values.select(F.from_json(value, schema).alias("__record")).select("__record.*")
