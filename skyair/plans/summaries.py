"""Daily summaries kept up to date: partial results per event day, refreshed for the days that changed (A1, A3-A5).

A run of ``refine_new`` leaves a list of the event days it has rewritten. Only these days of silver are read
and summarised again; their partial rows replace the old ones. Counts, sums, extremes and sketches merge, so
days, weeks and totals are derived from the partial rows without another look at silver.

    <lake>/summaries/<source>/event_date=<day>
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.operators.aggregation import activity_partials, daily_partials
from skyair.plans.refining import EVENT_DATE, changes_of
from skyair.sources.folders import exists, matching, publish, remove, staged_beside
from skyair.sources.readers import optional, read_parquet_files
from skyair.sources.writers import write_staged

PARTIALS: Mapping[str, Callable[[DataFrame], DataFrame]] = {"readings": daily_partials, "flights": activity_partials}


def refresh(spark: SparkSession, lake: str, name: str, partials: Callable[[DataFrame], DataFrame] | None = None) -> list[str] | None:
    """Bring a source's partial rows up to date with its silver.

    Returns the day folders that were worked out anew, None for all of them. A refresh that dies is repeated
    by the next one: the lists of changed days go last.
    """
    partials = partials or PARTIALS[name]
    silver, target = f"{lake}/silver/{name}", f"{lake}/summaries/{name}"
    lists = matching(spark, f"{changes_of(lake, name)}/*")
    whole = not exists(spark, target)
    if not whole and not lists:
        return []
    days = None
    if not whole:
        days = sorted(row[0] for row in spark.read.parquet(*lists).select("folder").distinct().collect())  # calendar days
    paths = [silver] if whole else [f"{silver}/{day}" for day in days if exists(spark, f"{silver}/{day}")]
    staged = staged_beside(target)
    remove(spark, staged)
    rows = None
    if paths:
        rows = optional(lambda: spark.read.option("basePath", silver).parquet(*paths), name)
    if rows is not None:
        made = partials(rows)
        write_staged(made.withColumn(EVENT_DATE, F.col("reading_date")), staged, [EVENT_DATE])
    if whole:
        if rows is not None:
            publish(spark, staged, target)
    else:
        for day in days:
            if exists(spark, f"{staged}/{day}"):
                publish(spark, f"{staged}/{day}", f"{target}/{day}")
            else:
                remove(spark, f"{target}/{day}")
        remove(spark, staged)
    for done in lists:
        remove(spark, done)
    return days


def read_partials(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The partial rows of all days; ``event_date`` prunes."""
    return read_parquet_files(spark, f"{lake}/summaries/{name}")
