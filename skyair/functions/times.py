"""Time conversions that give UTC results whatever zone the session is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def utc_wall(df: DataFrame, name: str) -> Column:
    """UTC wall-clock time (no zone) of a timestamp column of either kind.

    A zoned timestamp is counted from the epoch instead of being rendered, because rendering would
    go through the session zone.
    """
    if isinstance(df.schema[name].dataType, T.TimestampType):
        seconds = f"cast(unix_micros({_quoted(name)}) as decimal(18,0)) * 0.000001BD"
        return F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, {seconds})")
    return F.col(_quoted(name))


def utc_day(df: DataFrame, name: str) -> Column:
    """Calendar day in UTC of a timestamp or date column.

    A zoned timestamp is counted in whole days since the epoch: integers, and no session zone.
    """
    if isinstance(df.schema[name].dataType, T.TimestampType):
        days = F.floor(F.unix_micros(F.col(_quoted(name))) / F.lit(86_400_000_000))
        return F.date_from_unix_date(days.cast("int"))
    return F.to_date(F.col(_quoted(name)))


def as_instant(df: DataFrame, name: str) -> Column:
    """A zoned timestamp; a zone-less one is read as UTC (watermarks need the zoned kind)."""
    time = F.col(_quoted(name))
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        # Built from its parts, because a difference of two such times still goes through the session zone.
        parts = (F.extract(F.lit(part), time) for part in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND"))
        return F.make_timestamp_ltz(*parts, F.lit("UTC"))
    return time


def from_epoch(seconds: Column) -> Column:
    """Event time from epoch seconds."""
    return F.timestamp_seconds(seconds)


def parse_utc(text: Column) -> Column:
    """P5: ISO-8601 text to timestamp; text that is no timestamp becomes null."""
    return F.try_to_timestamp(text)


def days_before(df: DataFrame, name: str, days: int) -> Column:
    """P5: ``days`` days of 24 hours before a timestamp column, on the full second.

    A request start time has that form. Subtracting an interval from a zoned timestamp would count
    calendar days of the session zone, so its seconds are counted instead.
    """
    time = F.col(_quoted(name))
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.timestamp_seconds(F.unix_seconds(time) - days * 86400)
    fraction = F.pmod(F.extract(F.lit("SECOND"), time), F.lit(1).cast("decimal(1,0)"))
    return time - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), fraction)


def format_utc(df: DataFrame, name: str) -> Column:
    """P5: timestamp column to ISO-8601 text in UTC, full seconds."""
    return F.date_format(utc_wall(df, name), "yyyy-MM-dd'T'HH:mm:ss'Z'")
