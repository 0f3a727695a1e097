"""From location metadata and raw measurements to a bronze load of readings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair import schemas
from skyair.functions.times import days_before, parse_utc, utc_day
from skyair.operators.joining import enrich
from skyair.operators.selection import backfill_from, covering_locations, newest_rows
from skyair.operators.shaping import explode_sensors, flatten, reporting_sensors, target_parameters
from skyair.sources.writers import append_load

TIME = "period__datetime_from__utc"


def chosen_sensors(
    locations: DataFrame,
    targets: Sequence[str] = schemas.TARGET_PARAMETERS,
    locations_per_country: int = schemas.LOCATIONS_PER_COUNTRY,
) -> DataFrame:
    """One row per sensor to load: of the covering locations, a target parameter, and seen at least once."""
    sensors = explode_sensors(locations)
    places = covering_locations(sensors, targets, locations_per_country).select("country", "location_id")
    return reporting_sensors(target_parameters(sensors, targets)).join(places, ["country", "location_id"], "left_semi")


def first_day(sensors: DataFrame, days: int) -> date | None:
    """The UTC day on which the earliest of the sensors' backfill windows begins; None without sensors."""
    begins = sensors.select(days_before(sensors, "sensor_last", days).alias("begins"))
    return begins.select(F.min(utc_day(begins, "begins"))).first()[0]


def readings_to_land(
    locations: DataFrame,
    measurements: DataFrame,
    targets: Sequence[str] = schemas.TARGET_PARAMETERS,
    locations_per_country: int = schemas.LOCATIONS_PER_COUNTRY,
    rows_per_sensor: int | None = schemas.ROWS_PER_SENSOR,
    days: int | None = schemas.BACKFILL_DAYS,
    day: str | None = None,
) -> DataFrame:
    """The newest readings of the chosen sensors in the form of bronze, lineage excepted.

    ``measurements`` holds nested records with a ``sensor_id``. The sensors are few, so they are joined
    before anything is ranked. ``days`` bounds the age of a reading by its own sensor's last report; 0 or
    None takes readings of any age. Where ``measurements`` are partitioned by a ``day`` (the UTC day of
    their time), days before the window of every sensor are not read; that takes one small job.
    """
    sensors = chosen_sensors(locations, targets, locations_per_country)
    if day is not None:
        if days:
            measurements = measurements.filter(F.col(day) >= F.lit(first_day(sensors, days)))
        measurements = measurements.drop(day)
    flat = flatten(measurements)
    flat = flat.withColumn(TIME, parse_utc(F.col(TIME)))
    readings = enrich(flat, sensors)
    if days:
        readings = backfill_from(readings, TIME, "sensor_last", days)
    newest = newest_rows(readings, ["sensor_id"], TIME, rows_per_sensor)
    lineage = ("_load_id", "_load_time", "_row_id")
    declared = [name for name in schemas.READINGS.names if name not in lineage]
    extra = [name for name in flat.columns if name not in declared]
    return newest.select(*declared, *extra)


def land_readings(
    locations: DataFrame, measurements: DataFrame, path: str, load_id: str, loaded_at: datetime | None = None, **limits
) -> None:
    """Append one load of readings to bronze; ``limits`` as in ``readings_to_land``."""
    append_load(readings_to_land(locations, measurements, **limits), path, load_id, loaded_at)


#: The second, smaller variant of the load.
VARIANT = {
    "targets": schemas.VARIANT_PARAMETERS,
    "locations_per_country": 2,
    "rows_per_sensor": 15,
    "days": schemas.BACKFILL_DAYS,
}
