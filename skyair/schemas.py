"""Explicit schemas, business keys and fixed values of the datasets.

Nothing is inferred: a numeric column that happens to be all null, or a timestamp sent as text,
would otherwise change type from one run to the next.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Fixed values -----------------------------------------------------------------------------------
TARGET_PARAMETERS = ("pm25", "pm10", "no2", "o3", "so2", "co")
VARIANT_PARAMETERS = ("pm25", "pm10", "no2", "o3")
DASHBOARD_PARAMETERS = ("pm25", "pm10", "no2", "o3")
ROWS_PER_SENSOR = 50
LOCATIONS_PER_COUNTRY = 3
BACKFILL_DAYS = 7
TOP_DAYS = 20
FLUSH_RECORDS = 500
FLUSH_SECONDS = 30
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)

# name, position in the state array, type
STATE_FIELDS = (
    ("icao24", 0, "string"),
    ("callsign", 1, "string"),
    ("origin_country", 2, "string"),
    ("longitude", 5, "double"),
    ("latitude", 6, "double"),
    ("baro_altitude", 7, "double"),
    ("on_ground", 8, "boolean"),
    ("velocity", 9, "double"),
    ("true_track", 10, "double"),
    ("vertical_rate", 11, "double"),
    ("geo_altitude", 13, "double"),
    ("squawk", 14, "string"),
)

# Readings ---------------------------------------------------------------------------------------
MEASUREMENT = _struct(
    ("value", T.DoubleType()),
    ("period", _struct(("datetimeFrom", _struct(("utc", T.StringType()))))),
)

READINGS = _struct(
    ("sensor_id", T.LongType()),
    ("period__datetime_from__utc", T.TimestampType()),
    ("value", T.DoubleType()),
    ("parameter", T.StringType()),
    ("location_id", T.LongType()),
    ("location_name", T.StringType()),
    ("country", T.StringType()),
    ("_load_id", T.StringType()),
    ("_load_time", T.TimestampType()),
    ("_row_id", T.StringType()),
)
READINGS_KEYS = ("sensor_id", "period__datetime_from__utc")
READINGS_REQUIRED = ("value", "parameter", "location_id", "period__datetime_from__utc")

READINGS_VARIANT = _struct(
    ("sensor_id", T.LongType()),
    ("location_id", T.LongType()),
    ("location_name", T.StringType()),
    ("parameter", T.StringType()),
    ("country", T.StringType()),
    ("value", T.DoubleType()),
    ("datetime_from_utc", T.StringType()),
)
READINGS_VARIANT_KEYS = ("sensor_id", "datetime_from_utc")
READINGS_VARIANT_REQUIRED = ("sensor_id", "value", "parameter", "datetime_from_utc")

# Column checks of the loaded readings table: (check, column)
READINGS_CHECKS = (
    ("not_null", "sensor_id"),
    ("not_null", "parameter"),
    ("not_null", "value"),
    ("non_negative", "value"),
    ("not_null", "country"),
)

FLIGHTS_CHECKS = (("not_null", "icao24"), ("not_null", "observed_at"), ("not_null", "latitude"), ("not_null", "longitude"))

# Location and sensor metadata -------------------------------------------------------------------
_UTC = _struct(("utc", T.StringType()))
_PARAMETER = _struct(("name", T.StringType()))

SENSOR = _struct(("id", T.LongType()), ("parameter", _PARAMETER), ("datetimeLast", _UTC))
LOCATIONS = _struct(
    ("id", T.LongType()),
    ("name", T.StringType()),
    ("country", T.StringType()),
    ("datetimeLast", _UTC),
    ("sensors", T.ArrayType(SENSOR)),
)

# Flights ----------------------------------------------------------------------------------------
STATE_PAYLOAD = _struct(
    ("time", T.LongType()),
    ("states", T.ArrayType(T.ArrayType(T.StringType()))),
)
_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
FLIGHTS = _struct(
    ("region", T.StringType()),
    *((name, _TYPES[kind]) for name, _, kind in STATE_FIELDS),
    ("observed_at", T.TimestampType()),
    ("ingested_at", T.TimestampType()),
)
FLIGHTS_KEYS = ("icao24", "observed_at")
FLIGHTS_REQUIRED = ("icao24", "latitude", "longitude", "observed_at")

# Columns of the latest-state mart, in order
LATEST_STATE_COLUMNS = (
    "region",
    "icao24",
    "callsign",
    "origin_country",
    "longitude",
    "latitude",
    "baro_altitude",
    "geo_altitude",
    "on_ground",
    "velocity",
    "true_track",
    "vertical_rate",
    "observed_at",
)

# (x, y) metric pairs of the combined view
COMBINED_PAIRS = (
    ("flight_count", "avg_pm25"),
    ("avg_altitude", "avg_pm25"),
    ("avg_velocity", "avg_pm10"),
    ("flight_count", "avg_no2"),
)

BOXES = _struct(
    ("region", T.StringType()),
    ("lamin", T.DoubleType()),
    ("lomin", T.DoubleType()),
    ("lamax", T.DoubleType()),
    ("lomax", T.DoubleType()),
)
