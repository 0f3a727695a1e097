"""Bronze to silver and rejects in one pass, for a whole source or for what is new in it.

Every row of bronze is routed once: what is kept becomes silver, the rest goes to the rejects by reason. The
routed rows are written to a staging folder, whose folders then take their places by renaming.

What an incremental run needs of the past is small: the copies of a key share their event day, because the
event time is one of the keys, and the best of all copies is the best of (best of the old ones, new ones).
So the survivors of the touched days, kept or rejected, stand for all of bronze's older rows. Which files of
bronze are done is stored as a list of names. A plan of moves is written before the first of them, so a run
that dies is finished by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.functions.times import utc_day
from skyair.operators.cleaning import (
    CORRUPT_LINE,
    DUPLICATE,
    KEPT,
    MISSING,
    OUT_OF_RANGE,
    REASON,
    audit_of,
    route,
)
from skyair.sources.folders import add_files, exists, matching, move, publish, recover, remove
from skyair.sources.readers import CORRUPT, optional, read_parquet_files
from skyair.sources.writers import write_snapshot, write_staged

EVENT_DATE = "event_date"
#: Survivors of the dedup that are no good: worked out anew with every change of their day.
FAULTY = (MISSING, OUT_OF_RANGE)
#: Rejects that stay what they are, whatever comes later.
FINAL = (DUPLICATE, CORRUPT_LINE)


def _places(lake: str, name: str) -> tuple[str, str, str, str]:
    return tuple(f"{lake}/{layer}/{name}" for layer in ("silver", "rejects", "staging", "marks"))


def _files_of(df: DataFrame) -> list[str]:
    """Names of the files a frame reads; as many as the scan lists on the driver anyway."""
    return sorted(unquote(name) for name in df.inputFiles())


def _names(spark: SparkSession, files: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(name,) for name in files], "file string").coalesce(1)


def _write_routed(routed: DataFrame, path: str, partition_by: list[str]) -> None:
    write_staged(routed, path, partition_by, balanced=EVENT_DATE in partition_by)  # reasons are few, days are not
    kept = f"{path}/{REASON}={KEPT}"
    if not exists(routed.sparkSession, kept):
        routed.drop(*partition_by).limit(0).write.parquet(kept)


def refine_whole(
    bronze: DataFrame, lake: str, name: str, rules: dict, time: str, validate_first: bool = False, by_day: bool = True
) -> None:
    """All of ``bronze`` into silver and rejects, replacing what was there."""
    spark = bronze.sparkSession
    silver, rejects, staging, marks = _places(lake, name)
    files = _files_of(bronze)
    routed = route(bronze, **rules, validate_first=validate_first, corrupt=CORRUPT)
    routed = routed.withColumn(EVENT_DATE, utc_day(routed, time))
    remove(spark, staging)
    _write_routed(routed, f"{staging}/rows", [REASON, EVENT_DATE] if by_day else [REASON])
    remove(spark, changes_of(lake, name))
    remove(spark, f"{lake}/summaries/{name}")  # without it all days are summarised again
    remove(spark, marks)  # without a list every file counts as new, so a run that dies here loses nothing
    publish(spark, f"{staging}/rows/{REASON}={KEPT}", silver)
    publish(spark, f"{staging}/rows", rejects)
    write_snapshot(_names(spark, files), f"{marks}/whole")
    remove(spark, staging)


def _finish(spark: SparkSession, lake: str, name: str) -> None:
    """Make the moves of a plan that was written; every one of them can be repeated."""
    silver, rejects, staging, marks = _places(lake, name)
    if exists(spark, f"{staging}/plan"):
        for row in spark.read.parquet(f"{staging}/plan").collect():  # one row per reason and touched day
            staged = f"{staging}/rows/{REASON}={row.reason}/{row.folder}"
            place = f"{silver if row.reason == KEPT else f'{rejects}/{REASON}={row.reason}'}/{row.folder}"
            if row.reason in FINAL:
                add_files(spark, staged, place)
            elif not row.staged:
                remove(spark, place)
            elif exists(spark, staged):
                publish(spark, staged, place)
            else:
                recover(spark, place)
        if optional(lambda: read_parquet_files(spark, silver), name) is None:
            add_files(spark, f"{staging}/empty", silver)
        run = uuid4().hex
        if exists(spark, f"{staging}/files"):
            move(spark, f"{staging}/files", f"{marks}/{run}")
        move(spark, f"{staging}/plan", f"{changes_of(lake, name)}/{run}")  # what is derived from silver follows these
    remove(spark, staging)


def changes_of(lake: str, name: str) -> str:
    """Where the plans of finished runs wait for what is derived from silver by day (``summaries``)."""
    return f"{lake}/changes/{name}"


def _day_folder(day) -> str:
    return f"{EVENT_DATE}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def survivors(spark: SparkSession, lake: str, name: str, days: list) -> DataFrame | None:
    """What the dedup of earlier runs left of these event days, good or not; other days are not read."""
    silver, rejects, _, _ = _places(lake, name)
    day = F.col(EVENT_DATE).cast("date")  # where all folders are of no day, it is read as text
    touched = day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False))
    found = []
    for path, part in ((silver, F.lit(True)), (rejects, F.col(REASON).isin(*FAULTY) if exists(spark, rejects) else None)):
        rows = None if part is None else optional(lambda: read_parquet_files(spark, path), name)  # noqa: B023
        if rows is None:
            continue
        if EVENT_DATE not in rows.columns:
            continue
        found.append(rows.filter(touched & part).drop(REASON).withColumn(EVENT_DATE, day))
    if not found:
        return None
    return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)


def refine_new_files(
    bronze: DataFrame, read: Callable[[list[str]], DataFrame], lake: str, name: str, rules: dict, time: str, validate_first: bool = False
) -> list[str]:
    """Clean the event days touched by files of ``bronze`` that no run has read; returns these files.

    ``read`` reads a list of files as ``bronze`` was. Silver and rejects are then what ``refine_whole`` would
    make of all files. Of older rows only the touched days of silver and of the faulty rejects are read.
    """
    if time not in rules["keys"]:
        raise ValueError(f"the event time {time!r} has to be one of the keys {list(rules['keys'])}")
    spark = bronze.sparkSession
    silver, rejects, staging, marks = _places(lake, name)
    _finish(spark, lake, name)
    done = set()
    if exists(spark, marks):
        done = {row.file for row in spark.read.option("recursiveFileLookup", "true").schema("file string").parquet(marks).collect()}
    files = [file for file in _files_of(bronze) if file not in done]
    if not files:
        return []
    new = read(files)
    new = new.withColumn(EVENT_DATE, utc_day(new, time))
    days = [row[0] for row in new.select(EVENT_DATE).distinct().collect()]  # calendar days, not rows
    flat = matching(spark, f"{silver}/*.parquet") if done else []
    if flat and not read_parquet_files(spark, flat).isEmpty():
        raise ValueError(f"{silver} is not in folders by {EVENT_DATE}: refine all of it by day first")
    # Without a list of files silver is of unknown origin: all of it is built anew.
    old = survivors(spark, lake, name, days) if done else None
    if not done:
        for path in (silver, rejects, changes_of(lake, name), f"{lake}/summaries/{name}"):
            remove(spark, path)
    rows = new if old is None else new.unionByName(old, allowMissingColumns=True)
    routed = route(rows, **rules, validate_first=validate_first, corrupt=CORRUPT)
    write_staged(routed, f"{staging}/rows", [REASON, EVENT_DATE])
    routed.drop(REASON, EVENT_DATE).limit(0).write.parquet(f"{staging}/empty")
    _names(spark, files).write.parquet(f"{staging}/files")
    plan = [
        (reason, _day_folder(day), exists(spark, f"{staging}/rows/{REASON}={reason}/{_day_folder(day)}"))
        for reason in (KEPT, *FAULTY, *FINAL)
        for day in days
    ]
    listed = spark.createDataFrame(plan, "reason string, folder string, staged boolean").coalesce(1)
    listed.write.parquet(f"{staging}/plan.next")
    move(spark, f"{staging}/plan.next", f"{staging}/plan")  # from here on the run is finished, if need be by the next one
    _finish(spark, lake, name)
    return files


def stored_audit(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """C7 from what was written: row counts of every cleaning step, without touching bronze.

    Counting needs no column, so parquet answers from its footers.
    """
    silver, rejects, _, _ = _places(lake, name)
    recover(spark, silver)
    counts = read_parquet_files(spark, silver).agg(F.lit(KEPT).alias(REASON), F.count(F.lit(1)).alias("rows"))
    faulty = optional(lambda: read_rejects(spark, lake, name), name)
    if faulty is not None:
        counts = counts.unionByName(faulty.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows")))
    return audit_of(counts)


def read_rejects(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The rows of a source that did not stay, each with its reason."""
    rows = read_parquet_files(spark, _places(lake, name)[1])
    return rows if REASON in rows.columns else rows.withColumn(REASON, F.lit(None).cast("string"))
