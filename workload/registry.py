"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyair.functions.times import utc_wall

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text in UTC, so that two engines' results compare by value."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *(
            utc_wall(df, f.name).cast("string").alias(f.name) if isinstance(f.dataType, timed) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL that has to give the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Means rounded: the last bits of a sum of doubles depend on the order of summation."""
    return df.withColumns({name: F.round(name, places) for name in columns})
