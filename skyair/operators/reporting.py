"""What a dashboard asks of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.functions.text import concentration, day_label, measure, yes_no
from skyair.schemas import COMBINED_PAIRS, DASHBOARD_PARAMETERS, TOP_DAYS


def headline(
    daily: DataFrame,
    parameters: Sequence[str] = DASHBOARD_PARAMETERS,
    parameter: str = "parameter",
    value: str = "avg_value",
) -> DataFrame:
    """A4: mean of the daily means per parameter, with its display text.

    Every listed parameter gets a row, also one without readings (null, shown as a dash).
    """
    means = daily.agg(
        *(F.avg(F.when(F.col(parameter) == name, F.col(value))).alias(f"__mean_{i}") for i, name in enumerate(parameters))
    )
    rows = [
        F.struct(
            F.lit(name).alias("parameter"),
            F.upper(F.lit(name)).alias("title"),
            F.col(f"__mean_{i}").alias("mean_value"),
        )
        for i, name in enumerate(parameters)
    ]
    return means.select(F.inline(F.array(*rows))).withColumn("shown", concentration(F.col("mean_value")))


def trend(
    daily: DataFrame,
    wanted: str,
    parameter: str = "parameter",
    day: str = "reading_date",
    value: str = "avg_value",
) -> DataFrame:
    """A5: mean of the daily means per day for one parameter, in date order."""
    chosen = daily.filter(F.col(parameter) == wanted)
    return chosen.groupBy(day).agg(F.avg(value).alias("mean_value")).orderBy(day)


def worst_days(daily: DataFrame, wanted: str = "pm25", n: int = TOP_DAYS, mean: str = "avg_pm25") -> DataFrame:
    """L1: the ``n`` days and locations with the highest mean of one parameter, ties by key."""
    chosen = daily.filter(F.col("parameter") == wanted).select(
        "country", "location_id", "location_name", "reading_date", F.col("avg_value").alias(mean), "reading_count"
    )
    keys = ("country", "location_id", "location_name", "reading_date")
    return chosen.orderBy(F.col(mean).desc_nulls_last(), *keys).limit(n)


def with_day_label(days: DataFrame, name: str = "location_name", day: str = "reading_date") -> DataFrame:
    """P8."""
    return days.withColumn("label", day_label(F.col(name), F.col(day)))


def tracked(latest_states: DataFrame) -> DataFrame:
    """Number of aircraft in the latest-state mart."""
    return latest_states.agg(F.count(F.lit(1)).alias("aircraft_tracked"))


def live_cards(latest_states: DataFrame) -> DataFrame:
    """P10: display texts of the latest states."""
    identifier = F.coalesce(F.nullif("callsign", F.lit("")), F.col("icao24"))
    return latest_states.select(
        "icao24",
        "origin_country",
        F.concat(identifier, F.lit(" ("), F.col("origin_country"), F.lit(")")).alias("title"),
        measure(F.col("baro_altitude"), 0).alias("altitude"),
        measure(F.col("velocity"), 1).alias("ground_speed"),
        measure(F.col("true_track"), 0).alias("heading"),
        measure(F.col("vertical_rate"), 1).alias("climb"),
        yes_no(F.col("on_ground")).alias("grounded"),
    )


def listing(df: DataFrame, by: Sequence[str] = ("origin_country", "icao24")) -> DataFrame:
    """L3: all rows in order. The key follows the country, so one large country still splits by range."""
    return df.orderBy(*by)


def sample_rows(df: DataFrame, by: Sequence[str], n: int = 10) -> DataFrame:
    """L2: the first ``n`` rows by key."""
    return df.orderBy(*by).limit(n)


def metric_pairs(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]] = COMBINED_PAIRS,
    keep: Sequence[str] = ("country", "reading_date"),
) -> DataFrame:
    """Long form (x_metric, y_metric, x, y) of metric pairs; rows missing either side are dropped."""
    rows = [
        F.struct(
            F.lit(x).alias("x_metric"),
            F.lit(y).alias("y_metric"),
            F.col(x).cast("double").alias("x"),
            F.col(y).cast("double").alias("y"),
        )
        for x, y in pairs
    ]
    return df.select(*keep, F.inline(F.array(*rows))).na.drop(subset=["x", "y"])
