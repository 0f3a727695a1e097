"""From nested, positional and text payloads to typed rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyair.functions.text import blank_to_null
from skyair.functions.times import from_epoch, parse_utc
from skyair.schemas import LATEST_STATE_COLUMNS, STATE_FIELDS, STATE_PAYLOAD, TARGET_PARAMETERS


def snake_case(name: str) -> str:
    """``datetimeFrom`` to ``datetime_from``; anything but letters and digits to an underscore."""
    split = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"[^A-Za-z0-9_]", "_", split).lower()


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """Lift nested struct fields to top-level columns ``a__b__c``, names in snake_case.

    Arrays and maps stay as they are; a missing parent gives null. One projection, so only the leaves a
    query asks for are read. Two fields that end up with one name raise ``ValueError``.
    """

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            nested = isinstance(field.dataType, T.StructType)
            found += leaves(field.dataType, here) if nested else [here]
        return found

    columns = {}
    paths = leaves(df.schema, ())
    names = [separator.join(snake_case(part) for part in path) for path in paths]
    doubled = [name for name, times in Counter(names).items() if times > 1]
    if doubled:
        raise ValueError(f"flattened names collide: {sorted(doubled)}")
    for name, path in zip(names, paths):
        columns[name] = F.col(".".join(f"`{part.replace('`', '``')}`" for part in path))
    return df.select(*(column.alias(name) for name, column in columns.items()))


_CORRUPT = "_corrupt_record"


def parse_payloads(df: DataFrame, payload: str = "value") -> DataFrame:
    """Add the parsed payload as column ``parsed`` and whether it is well formed as ``well_formed``."""
    schema = T.StructType([*STATE_PAYLOAD.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = df.withColumn("parsed", F.from_json(payload, schema, {"columnNameOfCorruptRecord": _CORRUPT}))
    sound = F.col("parsed.time").isNotNull() & F.col(f"parsed.{_CORRUPT}").isNull()
    return parsed.withColumn("well_formed", sound)


def states_of(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Well-formed payloads to one typed row per state array, plus the ``keep`` columns."""
    # The outer form: for the plain one, as for a filter here, Spark parses every payload again below.
    sound = F.when(F.col("well_formed"), F.col("parsed.states"))
    state = F.explode_outer(sound).alias("__state")
    states = parsed.select(*keep, F.col("parsed.time").alias("__time"), state).filter("__state IS NOT NULL")

    def field(name: str, position: int, kind: str) -> Column:
        value = F.get("__state", F.lit(position))
        if name == "callsign":
            return blank_to_null(value).alias(name)
        return (value if kind == "string" else value.try_cast(kind)).alias(name)

    return states.select(
        *keep,
        *(field(*spec) for spec in STATE_FIELDS),
        from_epoch(F.col("__time")).alias("observed_at"),
        F.current_timestamp().alias("ingested_at"),
    )


def unpack_states(df: DataFrame, payload: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Payload text to one typed row per state array.

    A payload that is malformed, or has null or no states, gives no rows; a position missing from a
    short array, or holding text that does not fit the type, gives null.
    """
    return states_of(parse_payloads(df, payload), keep)


def explode_sensors(locations: DataFrame) -> DataFrame:
    """Location metadata to one row per sensor, with both last-seen times as timestamps.

    Columns: country, location_id, location_name, location_last, sensor_id, parameter, sensor_last.
    """
    rows = locations.select(
        "country",
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        parse_utc(F.col("datetimeLast.utc")).alias("location_last"),
        F.explode("sensors").alias("__sensor"),
    )
    return rows.select(
        "country",
        "location_id",
        "location_name",
        "location_last",
        F.col("__sensor.id").alias("sensor_id"),
        F.col("__sensor.parameter.name").alias("parameter"),
        parse_utc(F.col("__sensor.datetimeLast.utc")).alias("sensor_last"),
    )


def target_parameters(
    df: DataFrame, targets: Sequence[str] = TARGET_PARAMETERS, parameter: str = "parameter"
) -> DataFrame:
    """Keep rows of the wanted parameters."""
    return df.filter(F.col(parameter).isin(*targets))


def reporting_sensors(df: DataFrame, last: str = "sensor_last") -> DataFrame:
    """Drop sensors that never reported."""
    return df.filter(F.col(last).isNotNull())


def project(df: DataFrame, columns: Sequence[str] = LATEST_STATE_COLUMNS) -> DataFrame:
    """The output columns of a mart, in order."""
    return df.select(*columns)
