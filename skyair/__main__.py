"""Command line: ``spark-submit`` or ``python -m skyair <command> <lake> [options]``.

  refine   bronze to silver snapshots
  load     silver snapshots to warehouse tables
  build    all of it, marts included
  audit    row counts of each cleaning step, per source
  check    data-quality reports of the loaded tables, each written as a folder of JSON below <lake>/checks
  land     location metadata and measurements (JSON) to a bronze load of readings
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyair.operators.aggregation import breakdown
from skyair.operators.quality import column_checks, distinct_counts, duplicate_keys, null_counts, row_count
from skyair.operators.reporting import sample_rows
from skyair.operators.joining import unmapped_countries
from skyair.plans.landing import VARIANT, land_readings
from skyair.plans.medallion import SOURCES, audit_source, build, check_source, load_silver, refine, refine_new
from skyair.plans.models import GROUPS
from skyair.schemas import LOCATIONS, MEASUREMENT, READINGS_CHECKS, READINGS_KEYS
from skyair.session import build_session
from skyair.sources.writers import load_table

NAMES = tuple(source.name for source in SOURCES)


def quality_report(readings: DataFrame) -> dict[str, DataFrame]:
    """The checks of the readings table, by title."""
    return {
        "rows": row_count(readings),
        "sample": sample_rows(readings, READINGS_KEYS),
        "breakdown": breakdown(readings).orderBy("country", "parameter"),
        "nulls": null_counts(readings, ["value", "sensor_id", "location_id"]),
        "duplicates": duplicate_keys(readings, READINGS_KEYS, worst=None),
        "distinct": distinct_counts(
            readings, {"distinct_locations": "location_id", "distinct_sensors": "sensor_id"}
        ),
        "column checks": column_checks(readings, READINGS_CHECKS),
    }


def _countries(spark: SparkSession, where: str | None) -> DataFrame | None:
    if where is None:
        return None
    if spark.catalog.tableExists(where):
        return spark.table(where).select("alias", "country")
    return spark.read.schema("alias string, country string").json(where)


def report_unmapped(daily: DataFrame, countries: DataFrame, lake: str) -> None:
    """Country names that the mapping does not know, as a folder of JSON."""
    unmapped_countries(daily, countries).write.mode("overwrite").json(f"{lake}/checks/unmapped_countries")


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skyair", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("command", choices=["refine", "load", "build", "audit", "check", "land"])
    parser.add_argument("lake", help="root folder of the bronze and silver layers")
    parser.add_argument("--sources", nargs="+", choices=NAMES, default=NAMES)
    parser.add_argument("--groups", nargs="+", choices=GROUPS, default=GROUPS, help="mart groups to build")
    parser.add_argument("--validate-first", action="store_true", help="filter before the dedup: loses no good copy")
    parser.add_argument("--new", action="store_true", help="refine, build: only the event days that new bronze files touch")
    parser.add_argument("--no-days", action="store_true", help="do not partition silver by day")
    parser.add_argument("--countries", help="folder of JSON lines (alias, country), or a table, to conform country names")
    parser.add_argument("--locations", help="land: folder of location metadata")
    parser.add_argument("--measurements", help="land: folder of measurements, each with a sensor_id")
    parser.add_argument("--load-id", default="cli", help="land: lineage id of the load")
    parser.add_argument("--variant", action="store_true", help="land: the smaller variant; options below override it")
    parser.add_argument("--days", type=int, help="land: age of a reading at its sensor's last report at most; 0: any")
    parser.add_argument("--rows-per-sensor", type=int, help="land: newest rows of each sensor; 0: all")
    parser.add_argument("--locations-per-country", type=int, help="land: locations chosen in each country")
    parser.add_argument("--targets", nargs="+", help="land: names of the parameters to load")
    parser.add_argument("--day-folders", help="land: name of the day that the measurements' folders are named by")
    parser.add_argument("--buckets", type=int, default=0, help="load: deal tables by sensor or aircraft into so many buckets")
    parser.add_argument("--format", default="parquet", help="table format of the warehouse")
    given = parser.parse_args(arguments)
    save = partial(load_table, format=given.format)
    if given.command == "refine" and given.new:
        print("refined:", *refine_new(spark, given.lake, given.sources, given.validate_first))
    elif given.command == "refine":
        print("refined:", *refine(spark, given.lake, given.sources, given.validate_first, not given.no_days))
    elif given.command == "load":
        print("loaded:", *load_silver(spark, given.lake, given.sources, save, buckets=given.buckets).values())
    elif given.command == "build":
        marts = build(
            spark,
            given.lake,
            given.sources,
            given.groups,
            save,
            by_day=not given.no_days,
            validate_first=given.validate_first,
            countries=_countries(spark, given.countries),
            new_only=given.new,
        )
        print("built:", *marts)
        if given.countries and spark.catalog.tableExists("daily_summary"):
            report_unmapped(spark.table("daily_summary"), _countries(spark, given.countries), given.lake)
    elif given.command == "land":
        measured = T.StructType([T.StructField("sensor_id", T.LongType()), *MEASUREMENT.fields])
        if given.day_folders:
            measured = measured.add(given.day_folders, T.DateType())
        limits = {
            "days": given.days,
            "rows_per_sensor": given.rows_per_sensor,
            "locations_per_country": given.locations_per_country,
            "targets": given.targets,
            "day": given.day_folders,
        }
        land_readings(
            spark.read.schema(LOCATIONS).json(given.locations),
            spark.read.schema(measured).json(given.measurements),
            f"{given.lake}/bronze/readings",
            given.load_id,
            **(VARIANT if given.variant else {}) | {k: v for k, v in limits.items() if v is not None},
        )
        print("landed:", given.load_id)
    elif given.command == "audit":
        for source in SOURCES:
            counts = audit_source(spark, given.lake, source) if source.name in given.sources else None
            if counts is not None:
                print(source.name)
                counts.show()
    else:
        for source in SOURCES:
            table = f"{source.name}_processed"
            if source.name not in given.sources or not spark.catalog.tableExists(table):
                continue
            reports = {"checks": check_source(spark, source)}
            if source.name == "readings":
                reports |= quality_report(spark.table(table))
            for title, report in reports.items():
                folder = f"{given.lake}/checks/{source.name}/{title.replace(' ', '_')}"
                report.write.mode("overwrite").json(folder)
                print(f"{source.name} {title}: {folder}")


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    run(build_session())
