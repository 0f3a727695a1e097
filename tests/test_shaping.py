import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.helpers import at, shown_plan, tuples

from skyair.operators.shaping import (
    explode_sensors,
    flatten,
    parse_payloads,
    project,
    reporting_sensors,
    snake_case,
    target_parameters,
    unpack_states,
)
from skyair.schemas import FLIGHTS, LATEST_STATE_COLUMNS, LOCATIONS, MEASUREMENT


@pytest.mark.parametrize(
    "name, expected",
    [("datetimeFrom", "datetime_from"), ("utc", "utc"), ("PM25Value", "pm25_value"), ("user-id", "user_id"), ("icao24", "icao24")],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_flatten_nested_measurement(spark):
    rows = [(12.5, (("2026-01-01T00:00:00Z",),)), (1.0, (None,)), (2.0, None)]
    out = flatten(spark.createDataFrame(rows, MEASUREMENT))
    assert out.columns == ["value", "period__datetime_from__utc"]
    assert tuples(out) == [(1.0, None), (12.5, "2026-01-01T00:00:00Z"), (2.0, None)]


def test_flatten_keeps_arrays_and_odd_names(spark):
    df = spark.sql("SELECT array(named_struct('a', 1)) AS items, named_struct('x.y', 2) AS `Outer.One`")
    out = flatten(df)
    assert out.columns == ["items", "outer_one__x_y"]
    assert isinstance(out.schema["items"].dataType, T.ArrayType)


def test_flatten_reports_collisions(spark):
    with pytest.raises(ValueError, match="a__b"):
        flatten(spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a__b"))


def test_flatten_reads_only_what_is_used(spark, tmp_path):
    spark.sql("SELECT 1 AS id, named_struct('b', 1, 'c', 2) AS a").write.parquet(str(tmp_path / "d"))
    plan = shown_plan(flatten(spark.read.parquet(str(tmp_path / "d"))).select("a__c"))
    assert "ReadSchema: struct<a:struct<c:int>>" in plan


def state(*overrides):
    values = ["abc123", " BAW1  ", "United Kingdom", 1, 2, -0.5, 51.5, 1000, False, 230.5, 90, -1.5, [1, 2], 1010.0, "0042", False, 0]
    for position, value in overrides:
        values[position] = value
    return values


PAYLOADS = [
    json.dumps({"time": 1767225600, "states": [state(), state((0, "def456"), (1, None), (5, None), (8, True), (13, None))]}),
    json.dumps({"time": 1767225601, "states": None}),
    json.dumps({"time": 1767225602, "states": []}),
    json.dumps({"time": 1767225603, "states": [state((0, "short"))[:9], state((0, "odd"), (6, "north"), (1, "\t "))]}),
    '{"time": 1767225604, "states": [["x"',
    "",
    None,
    json.dumps({"states": [state()]}),
]


def test_unpack_states(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAYLOADS)], "n int, value string")
    out = unpack_states(df.filter("n < 7"), keep=["n"])
    types = {f.name: f.dataType for f in FLIGHTS.fields if f.name != "region"}
    assert {f.name: f.dataType for f in out.schema.fields if f.name != "n"} == types
    rows = {r.icao24: r for r in out.collect()}
    assert set(rows) == {"abc123", "def456", "short", "odd"}
    full = rows["abc123"]
    assert (full.callsign, full.longitude, full.latitude, full.baro_altitude) == ("BAW1", -0.5, 51.5, 1000.0)
    assert (full.on_ground, full.velocity, full.true_track, full.vertical_rate) == (False, 230.5, 90.0, -1.5)
    assert (full.geo_altitude, full.squawk, full.observed_at) == (1010.0, "0042", at("2026-01-01"))
    assert full.ingested_at is not None
    other = rows["def456"]
    assert (other.callsign, other.longitude, other.on_ground, other.geo_altitude) == (None, None, True, None)
    assert (rows["short"].on_ground, rows["short"].velocity, rows["short"].squawk) == (False, None, None)
    assert (rows["odd"].latitude, rows["odd"].callsign, rows["odd"].longitude) == (None, None, -0.5)


def test_malformed_payloads_are_told_apart(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAYLOADS)], "n int, value string")
    flags = {r.n: r.well_formed for r in parse_payloads(df).collect()}
    assert flags == {0: True, 1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False}


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([(PAYLOADS[0],)], "value string")
    plan = unpack_states(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


LOCATION_ROWS = [
    (1, "Roof", "US", ("2026-01-02T00:00:00Z",), [(11, ("pm25",), ("2026-01-02T00:00:00Z",)), (12, ("temperature",), None)]),
    (2, None, "PK", None, [(21, ("no2",), (None,))]),
    (3, "Empty", "PK", None, []),
]


def test_sensor_metadata(spark):
    sensors = explode_sensors(spark.createDataFrame(LOCATION_ROWS, LOCATIONS))
    assert tuples(sensors) == [
        ("PK", 2, None, None, 21, "no2", None),
        ("US", 1, "Roof", at("2026-01-02"), 11, "pm25", at("2026-01-02")),
        ("US", 1, "Roof", at("2026-01-02"), 12, "temperature", None),
    ]
    assert tuples(target_parameters(sensors), "sensor_id") == [(11,), (21,)]
    assert tuples(reporting_sensors(sensors), "sensor_id") == [(11,)]
    assert tuples(target_parameters(sensors, ["no2"]), "sensor_id") == [(21,)]


def test_projection_drops_what_the_mart_does_not_show(spark):
    out = project(spark.createDataFrame([], FLIGHTS).withColumn("rank", F.lit(1)))
    assert tuple(out.columns) == LATEST_STATE_COLUMNS
    assert not {"squawk", "ingested_at", "rank"} & set(out.columns)
