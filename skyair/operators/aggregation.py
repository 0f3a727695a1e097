"""Daily summaries, conditional pivots, breakdowns, and partial results that merge.

All of them combine on the map side before the shuffle, so a hot group reaches its reducer as one
partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.functions.times import utc_day


def daily_summary(
    readings: DataFrame,
    time: str = "period__datetime_from__utc",
    value: str = "value",
    by: Sequence[str] = ("country", "location_id", "location_name", "parameter"),
) -> DataFrame:
    """A1: count, mean, minimum and maximum per group and UTC day."""
    return readings.groupBy(*by, utc_day(readings, time).alias("reading_date")).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.avg(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def daily_partials(
    readings: DataFrame,
    time: str = "period__datetime_from__utc",
    value: str = "value",
    by: Sequence[str] = ("country", "location_id", "location_name", "parameter"),
) -> DataFrame:
    """A1 in parts that merge: counts, sum, minimum and maximum per group and UTC day, no mean yet."""
    return readings.groupBy(*by, utc_day(readings, time).alias("reading_date")).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.count(value).alias("value_count"),
        F.sum(value).alias("value_sum"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def merged_summary(
    partials: DataFrame, by: Sequence[str] = ("country", "location_id", "location_name", "parameter", "reading_date")
) -> DataFrame:
    """A1 from partial rows, any number per group; a coarser ``by`` rolls days or locations up exactly."""
    return partials.groupBy(*by).agg(
        F.sum("reading_count").alias("reading_count"),
        F.try_divide(F.sum("value_sum"), F.sum("value_count")).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


#: Binary logarithm of a sketch's registers: a distinct count is within about 2 % (one sigma 1.04 / 2^(k/2), 0.8 %).
SKETCH_BITS = 14


def activity_partials(
    flights: DataFrame,
    country: str = "origin_country",
    time: str = "observed_at",
    aircraft: str = "icao24",
    altitude: str = "baro_altitude",
    velocity: str = "velocity",
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """A3 in parts that merge: a sketch of the aircraft, sums and counts per country and UTC day."""
    sums = [
        column
        for value, name in ((altitude, "altitude"), (velocity, "velocity"))
        for column in (F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count"))
    ]
    grouped = flights.groupBy(F.col(country).alias("country"), utc_day(flights, time).alias("reading_date"))
    return grouped.agg(F.hll_sketch_agg(aircraft, bits).alias("aircraft_sketch"), *sums)


def merged_activity(partials: DataFrame, by: Sequence[str | Column] = ("country", "reading_date")) -> DataFrame:
    """A3 from partial rows, for days, weeks, countries or all: an estimate of the distinct aircraft, exact means."""
    return partials.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("aircraft_sketch")).alias("flight_count"),
        F.try_divide(F.sum("altitude_sum"), F.sum("altitude_count")).alias("avg_altitude"),
        F.try_divide(F.sum("velocity_sum"), F.sum("velocity_count")).alias("avg_velocity"),
    )


def pivot_mean(
    df: DataFrame,
    by: Sequence[str],
    columns: Mapping[str, str],
    parameter: str = "parameter",
    value: str = "avg_value",
) -> DataFrame:
    """A2: one column per listed parameter, ``{output column: parameter}``, holding its mean.

    The list is explicit, so there is no extra pass to discover the values.
    """
    means = [F.avg(F.when(F.col(parameter) == wanted, F.col(value))).alias(name) for name, wanted in columns.items()]
    return df.groupBy(*by).agg(*means)


def flight_activity(
    flights: DataFrame,
    country: str = "origin_country",
    time: str = "observed_at",
    aircraft: str = "icao24",
    altitude: str = "baro_altitude",
    velocity: str = "velocity",
    approximate: float | None = None,
) -> DataFrame:
    """A3: distinct aircraft, mean altitude and mean velocity per country and UTC day.

    ``approximate`` is a relative error for the distinct count. It replaces the second shuffle, keyed by
    aircraft, with a fixed-size sketch per group.
    """
    if approximate is None:
        distinct = F.countDistinct(aircraft)
    else:
        distinct = F.approx_count_distinct(aircraft, approximate)
    return flights.groupBy(F.col(country).alias("country"), utc_day(flights, time).alias("reading_date")).agg(
        distinct.alias("flight_count"),
        F.avg(altitude).alias("avg_altitude"),
        F.avg(velocity).alias("avg_velocity"),
    )


def breakdown(
    df: DataFrame, by: Sequence[str] = ("country", "parameter"), time: str = "period__datetime_from__utc"
) -> DataFrame:
    """Row count with first and last reading per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("measurement_count"),
        F.min(time).alias("earliest_reading"),
        F.max(time).alias("latest_reading"),
    )
