"""Row predicates for cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyair.schemas import LATITUDE_RANGE, LONGITUDE_RANGE


def in_range(name: str, low: float | None = None, high: float | None = None) -> Column:
    """True when the value is present, is a number and lies in [low, high]; never null.

    NaN has to be excluded by name: Spark orders it above every number, so ``NaN >= 0`` holds.
    """
    value = F.col(name)
    ok = value.isNotNull() & ~F.isnan(value)
    if low is not None:
        ok = ok & (value >= low)
    if high is not None:
        ok = ok & (value <= high)
    return F.coalesce(ok, F.lit(False))


def valid_position(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    return in_range(latitude, *LATITUDE_RANGE) & in_range(longitude, *LONGITUDE_RANGE)


def valid_reading(value: str = "value") -> Column:
    return in_range(value, low=0.0)
