"""Spark session for the command line, tests and benchmarks.

Library code never pins a master or changes a running session: it takes the session it is given. On large
inputs set ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` to the number of partitions a shuffle
of the largest table needs (about 128 MB each); adaptive execution merges them again where there is less.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "skyair", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the zone pinned to UTC and adaptive execution on; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
