"""Latest rows, backfill windows and the choice of locations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyair.functions.times import days_before
from skyair.operators.ranking import newest_first, top_per_key
from skyair.operators.skew import hot_keys, salted_join

_LAST = "__last"
_ROWS = "__rows"


def latest(df: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The latest row of every key; ties in time go to the largest other columns."""
    return top_per_key(df, keys, newest_first(df, keys, [time], tiebreak))


def backfill_window(df: DataFrame, keys: Sequence[str], time: str, days: int) -> DataFrame:
    """Rows at most ``days`` days older than the last row *of their own key*, bound included.

    The last time per key combines on the map side and is joined back with hot keys split: a window over
    the key would put a hot key's whole history into one task.
    """
    per_key = df.groupBy(*keys).agg(F.max(time).alias(_LAST), F.count(F.lit(1)).alias(_ROWS))
    # True for every key. With the count in use here too, both uses of ``per_key`` share one aggregation.
    anchors = per_key.filter(F.col(_ROWS) > 0).drop(_ROWS)
    anchored = salted_join(df, anchors, keys, hot_keys(per_key, keys, _ROWS), "left", null_safe=True)
    return anchored.filter(F.col(time) >= days_before(anchored, _LAST, days)).drop(_LAST)


def backfill_from(df: DataFrame, time: str, last_seen: str, days: int) -> DataFrame:
    """W2 where each row already carries its sensor's last-seen time (from metadata): a plain filter."""
    return df.filter(F.col(time) >= days_before(df, last_seen, days))


def newest_rows(
    df: DataFrame, keys: Sequence[str], time: str, n: int | None, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` most recent rows of every key; 0 or None means no cap."""
    if not n:
        return df
    return top_per_key(df, keys, newest_first(df, keys, [time], tiebreak), n)


def backfill_tail(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    days: int,
    n: int | None,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """W2 then W3. The window and the cap are both prefixes of one order (newest first), so they commute:
    capping first leaves at most ``n`` rows per key, among them the last one, in a single shuffle."""
    if not n:
        return backfill_window(df, keys, time, days)
    capped = newest_rows(df, keys, time, n, tiebreak)
    capped = capped.withColumn(_LAST, F.max(time).over(Window.partitionBy(*keys)))
    return capped.filter(F.col(time) >= days_before(capped, _LAST, days)).drop(_LAST)


def _by_recency(last: str, location: str):
    return [F.col(last).desc_nulls_last(), F.col(location).asc()]


def active_locations(
    sensors: DataFrame,
    targets: Sequence[str],
    k: int,
    country: str = "country",
    location: str = "location_id",
    parameter: str = "parameter",
    last: str = "location_last",
) -> DataFrame:
    """Per country the ``k`` most recently reporting locations that have a target sensor.

    Input has one row per location and sensor, each with the location's last time; output is (country,
    location, last). A location that never reported sorts last; equal times go to the smaller id.
    """
    candidates = sensors.filter(F.col(parameter).isin(*targets))
    return _most_recent(candidates, k, country, location, last)


def _most_recent(candidates: DataFrame, k: int, country: str, location: str, last: str) -> DataFrame:
    locations = candidates.groupBy(country, location).agg(F.max(last).alias(last))
    return top_per_key(locations, [country], _by_recency(last, location), k)


def covering_locations(
    sensors: DataFrame,
    targets: Sequence[str],
    k: int,
    country: str = "country",
    location: str = "location_id",
    parameter: str = "parameter",
    last: str = "location_last",
) -> DataFrame:
    """As W4, but locations that add a parameter not seen so far (scanning by recency) come first.

    A scan by recency takes a location for coverage exactly when it is the first to carry some
    parameter, so the covering ones are the top location per (country, parameter). The rest is filled
    by recency, for which the ``k`` most recent locations are enough, as each covering one among them
    frees a place. Both lists are small; the flag ``adds_parameter`` tells them apart.
    """
    candidates = sensors.filter(F.col(parameter).isin(*targets))
    carried = candidates.groupBy(country, location, parameter).agg(F.max(last).alias(last))
    pioneers = top_per_key(carried, [country, parameter], _by_recency(last, location))
    recent = _most_recent(carried, k, country, location, last)
    listed = pioneers.select(country, location, last, F.lit(True).alias("adds_parameter")).union(
        recent.select(country, location, last, F.lit(False))
    )
    merged = listed.groupBy(country, location).agg(
        F.max(last).alias(last), F.max("adds_parameter").alias("adds_parameter")
    )
    order = [F.col("adds_parameter").desc(), *_by_recency(last, location)]
    return top_per_key(merged, [country], order, k)
