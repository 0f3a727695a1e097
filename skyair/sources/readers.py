"""Batch sources."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyair.operators.quality import require_schema

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


Paths = str | Sequence[str]


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_json_lines(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """A directory (or files) of JSON-lines with a declared schema; blank lines are skipped.

    A line that does not parse, or holds a value of the wrong type, keeps its text in ``_corrupt_record``;
    ``split_corrupt`` separates such lines.
    """
    return spark.read.schema(with_corrupt_column(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(_listed(path))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, texts that did not)."""
    first = next(name for name in df.columns if name != CORRUPT)
    # Always true. Spark refuses a scan that needs only the corrupt column, as counting the good rows
    # would; naming a data column keeps that legal.
    any_value = F.coalesce(F.col(first).cast("string"), F.lit("")) >= ""
    good = df.filter(F.col(CORRUPT).isNull() & any_value).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull() & any_value).select(CORRUPT)
    return good, bad


def read_parquet_files(spark: SparkSession, path: Paths, schema: T.StructType | None = None) -> DataFrame:
    """The ``.parquet`` files of a directory as one table; other files there are ignored."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    return (reader.schema(schema) if schema else reader).parquet(*_listed(path))


def read_parquet_declared(spark: SparkSession, path: Paths, declared: T.StructType) -> DataFrame:
    """S2 with a declared schema: its columns first, then every other column any file has, by name.

    All footers are merged, so what comes back does not depend on which file is looked at first. A
    declared column that no file has is null; one of another type raises ``SchemaMismatch``.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true")
    merged = {field.name: field for field in reader.parquet(*_listed(path)).schema.fields}
    present = T.StructType([merged.get(f.name, f) for f in declared.fields])
    require_schema(spark.createDataFrame([], present), declared)
    names = set(declared.names)
    extra = sorted((f for f in merged.values() if f.name not in names), key=lambda f: f.name)
    return read_parquet_files(spark, path, T.StructType([*declared.fields, *extra]))


def optional(read: Callable[[], DataFrame], name: str = "source") -> DataFrame | None:
    """S3: ``read()``, or None when the input is missing or unreadable.

    Only the read is guarded. A wrong column name used on the frame later is an error, not a missing
    source.
    """
    try:
        return read()
    except AnalysisException as error:
        log.warning("skipping %s: %s", name, error)
        return None
