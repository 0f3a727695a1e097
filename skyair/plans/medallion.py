"""From bronze files to silver snapshots, warehouse tables and marts (S3, S4 and all the rest)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyair import schemas
from skyair.functions.predicates import valid_position, valid_reading
from skyair.functions.times import parse_utc, utc_day
from skyair.operators.cleaning import audit
from skyair.operators.quality import load_checks, require_schema
from skyair.plans.models import GROUPS, build_models, default_models
from skyair.plans.refining import EVENT_DATE, refine_new_files, refine_whole
from skyair.sources.folders import matching, recover
from skyair.sources.readers import CORRUPT, Paths, optional, read_json_lines, read_parquet_declared, read_parquet_files
from skyair.sources.writers import evenly_keyed, load_table

CHECKS = "load_checks"


@dataclass(frozen=True)
class Source:
    """How one source is read and cleaned. ``valid`` makes its predicate when a session exists."""

    name: str
    read: Callable[[SparkSession, Paths], DataFrame]
    keys: tuple[str, ...]
    required: tuple[str, ...]
    valid: Callable[[], Column]
    newest: tuple[str, ...]
    time: str
    keep_first: bool = False
    checks: tuple[tuple[str, str], ...] = ()
    # Columns that settle ties in ``newest``; None compares all others.
    tiebreak: tuple[str, ...] | None = None
    # Columns the loaded table has to have, with their types.
    declared: T.StructType | None = None

    def rules(self) -> dict:
        return {
            "keys": self.keys,
            "required": self.required,
            "valid": self.valid(),
            "newest": self.newest,
            "keep_first": self.keep_first,
            "tiebreak": self.tiebreak,
        }


def _read_readings(spark: SparkSession, path: Paths) -> DataFrame:
    # Loads may bring columns that earlier ones lack, such as units: they are carried along.
    return read_parquet_declared(spark, path, schemas.READINGS)


def _read_flights(spark: SparkSession, path: Paths) -> DataFrame:
    # A line that does not parse keeps its text, and goes to the rejects.
    return read_json_lines(spark, path, schemas.FLIGHTS).select(*schemas.FLIGHTS.names, CORRUPT)


def _read_readings_variant(spark: SparkSession, path: Paths) -> DataFrame:
    # Files are named by the time they were written, so the file name is the order of arrival.
    lines = read_json_lines(spark, path, schemas.READINGS_VARIANT)
    time = parse_utc(F.col("datetime_from_utc"))
    return lines.select(
        *(time.alias(name) if name == "datetime_from_utc" else name for name in schemas.READINGS_VARIANT.names),
        F.col("_metadata.file_name").alias("source_file"),
        CORRUPT,
    )


READINGS = Source(
    "readings",
    _read_readings,
    schemas.READINGS_KEYS,
    schemas.READINGS_REQUIRED,
    valid_reading,
    ("_load_time",),
    "period__datetime_from__utc",
    checks=schemas.READINGS_CHECKS,
    tiebreak=("_load_id", "_row_id"),
    declared=schemas.READINGS,
)
# The small, self-contained form: JSON-lines, the first copy to arrive is kept, another required set.
READINGS_VARIANT = Source(
    "readings_variant",
    _read_readings_variant,
    schemas.READINGS_VARIANT_KEYS,
    schemas.READINGS_VARIANT_REQUIRED,
    valid_reading,
    ("source_file",),
    "datetime_from_utc",
    keep_first=True,
    checks=schemas.READINGS_CHECKS,
)
FLIGHTS = Source(
    "flights",
    _read_flights,
    schemas.FLIGHTS_KEYS,
    schemas.FLIGHTS_REQUIRED,
    valid_position,
    ("ingested_at",),
    "observed_at",
    checks=schemas.FLIGHTS_CHECKS,
    declared=schemas.FLIGHTS,
)
SOURCES = (READINGS, FLIGHTS, READINGS_VARIANT)


def _chosen(names: Collection[str] | None, sources: Collection[Source]) -> list[Source]:
    if names is None:
        return list(sources)
    unknown = set(names) - {source.name for source in sources}
    if unknown:
        raise ValueError(f"unknown sources {sorted(unknown)}")
    return [source for source in sources if source.name in names]


def refine(
    spark: SparkSession,
    lake: str,
    names: Collection[str] | None = None,
    validate_first: bool = False,
    by_day: bool = True,
    sources: Collection[Source] = SOURCES,
) -> list[str]:
    """Clean ``lake/bronze/<source>`` into a snapshot ``lake/silver/<source>``, one pass per source.

    Rows that do not stay go to ``lake/rejects/<source>`` by reason, so nothing vanishes and
    ``refining.stored_audit`` counts every step from what was written. Snapshots are partitioned by event
    day, so that queries over some days read only those; ``by_day`` turns that off for a long history of few
    rows, where it would leave a folder of crumbs per day. A source without readable bronze is skipped.
    Returns the names of the sources written.
    """
    written = []
    for source in _chosen(names, sources):
        bronze = optional(lambda: source.read(spark, f"{lake}/bronze/{source.name}"), source.name)
        if bronze is None:
            continue
        refine_whole(bronze, lake, source.name, source.rules(), source.time, validate_first, by_day)
        written.append(source.name)
    return written


def refine_new(
    spark: SparkSession,
    lake: str,
    names: Collection[str] | None = None,
    validate_first: bool = False,
    sources: Collection[Source] = SOURCES,
) -> list[str]:
    """As ``refine``, but clean only the event days that files new in bronze touch.

    Returns the names of the sources that had new files. ``validate_first`` has to be the same in all runs.
    """
    written = []
    for source in _chosen(names, sources):
        bronze = optional(lambda: source.read(spark, f"{lake}/bronze/{source.name}"), source.name)
        if bronze is None:
            continue
        read = lambda files: source.read(spark, files)  # noqa: E731, B023
        if refine_new_files(bronze, read, lake, source.name, source.rules(), source.time, validate_first):
            written.append(source.name)
    return written


def audit_source(spark: SparkSession, lake: str, source: Source) -> DataFrame | None:
    """Row counts of each cleaning step over a source's bronze (C7); None if there is none to read."""
    bronze = optional(lambda: source.read(spark, f"{lake}/bronze/{source.name}"), source.name)
    return None if bronze is None else audit(bronze, **source.rules())


def load_silver(
    spark: SparkSession,
    lake: str,
    names: Collection[str] | None = None,
    save: Callable[[DataFrame, str], None] = load_table,
    sources: Collection[Source] = SOURCES,
    buckets: int = 0,
) -> dict[str, str]:
    """Replace each source's table by its silver snapshot; returns {source: table} of those loaded.

    With ``buckets`` a table is dealt by its entity (sensor, aircraft) instead of by day, so that latest rows,
    newest rows and duplicate keys need no shuffle. Where one entity has too large a share of the rows for
    even buckets, the table keeps its days. Silver that is not in day folders (``refine`` without ``by_day``)
    is loaded as it lies: by day its table would be the crumbs that silver was spared.
    """
    loaded = {}
    for source in _chosen(names, sources):
        path = f"{lake}/silver/{source.name}"
        recover(spark, path)
        # Silver is read as a partitioned table, so the day folders come back as a column.
        silver = optional(lambda: read_parquet_files(spark, path), source.name)
        if silver is None:
            continue
        silver = silver.drop(CORRUPT)  # null in every row that was kept
        if source.declared is not None:
            require_schema(silver.select(*(n for n in source.declared.names if n in silver.columns)), source.declared)
        table = f"{source.name}_processed"
        entity = list(source.keys[:1])
        if buckets and evenly_keyed(silver, entity, buckets):
            save(silver, table, bucket_by=entity, buckets=buckets)
        elif EVENT_DATE in silver.columns and matching(spark, f"{path}/{EVENT_DATE}=*"):
            save(silver, table, partition_by=[EVENT_DATE])
        else:
            save(silver, table)
        loaded[source.name] = table
    return loaded


def check_source(spark: SparkSession, source: Source, table: str | None = None) -> DataFrame:
    """Q1-Q7 of a source's loaded table: rows (source, check_name, column_name, failures, passed)."""
    loaded = spark.table(table or f"{source.name}_processed")
    expected = None
    if source.declared is not None:
        loaded = loaded.select(*source.declared.names)
        expected = source.declared
    return load_checks(loaded, source.name, source.keys, source.checks, expected)


def check_loaded(
    spark: SparkSession,
    tables: Mapping[str, str],
    save: Callable[..., None] = load_table,
    sources: Collection[Source] = SOURCES,
    name: str = CHECKS,
) -> str | None:
    """Check every loaded table and store the results as one table; returns its name."""
    results = None
    for source in sources:
        if source.name in tables:
            found = check_source(spark, source, tables[source.name])
            results = found if results is None else results.unionByName(found)
    if results is None:
        return None
    save(results, name)
    return name


def build(
    spark: SparkSession,
    lake: str,
    names: Collection[str] | None = None,
    groups: Collection[str] = GROUPS,
    save: Callable[..., None] = load_table,
    by_day: bool = True,
    validate_first: bool = False,
    countries: DataFrame | None = None,
    new_only: bool = False,
) -> list[str]:
    """Bronze to marts for the chosen sources; returns the names of the marts built.

    ``new_only`` refines what is new in bronze (``refine_new``) instead of all of it.

    The loaded tables are checked before a mart reads them and the results stored as ``load_checks``; a
    table whose schema differs from the declared one stops the build. ``countries`` (alias, country)
    brings both sides of the correlation to one form of country name.
    """
    if new_only:
        refine_new(spark, lake, names, validate_first)
    else:
        refine(spark, lake, names, validate_first, by_day)
    tables = load_silver(spark, lake, names, save)
    check_loaded(spark, tables, save)
    staging = {f"staging_{source}": spark.table(table) for source, table in tables.items()}
    return build_models(spark, staging, save, groups, default_models(countries))
