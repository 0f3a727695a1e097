"""Marts, each a composition of operators over staging tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from skyair.operators.aggregation import flight_activity, pivot_mean
from skyair.operators.aggregation import daily_summary as summarise
from skyair.operators.joining import aligned_full_join, conform_country
from skyair.operators.reporting import worst_days
from skyair.operators.selection import latest
from skyair.operators.shaping import project
from skyair.schemas import LATEST_STATE_COLUMNS

POLLUTANT_COLUMNS = {f"avg_{name}": name for name in ("pm25", "pm10", "no2", "o3")}
COUNTRY_DAY = ("country", "reading_date")
CORRELATION_COLUMNS = (*COUNTRY_DAY, *POLLUTANT_COLUMNS, "flight_count", "avg_altitude", "avg_velocity")


def daily_summary(readings: DataFrame, time: str = "period__datetime_from__utc") -> DataFrame:
    """Readings per country, location, parameter and day (A1)."""
    return summarise(readings, time)


def polluted_days(daily: DataFrame, parameter: str = "pm25") -> DataFrame:
    """The days and locations with the highest mean (L1)."""
    return worst_days(daily, parameter)


def latest_states(flights: DataFrame, columns: Sequence[str] = LATEST_STATE_COLUMNS) -> DataFrame:
    """The latest state of every aircraft."""
    return project(latest(flights, ["icao24"], "observed_at"), columns)


def correlation(
    daily: DataFrame,
    flights: DataFrame,
    pollutants: Mapping[str, str] = POLLUTANT_COLUMNS,
    countries: DataFrame | None = None,
) -> DataFrame:
    """Pollutant means next to flight activity per country and day, either side may be missing.

    Pollutants average the location-day means, not the readings; altitude and velocity average every
    observation; ``flight_count`` counts aircraft. ``countries`` (alias, country) brings both sides to
    one form of country name first (J4). Both sides are grouped by the join keys, so the join adds no
    shuffle.
    """
    if countries is not None:
        daily = conform_country(daily, countries)
        flights = conform_country(flights, countries, "origin_country")
    pollution = pivot_mean(daily, COUNTRY_DAY, pollutants)
    joined = aligned_full_join(pollution, flight_activity(flights), COUNTRY_DAY)
    return joined.select(*COUNTRY_DAY, *pollutants, "flight_count", "avg_altitude", "avg_velocity")
