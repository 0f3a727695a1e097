from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, tuples

from skyair.__main__ import run
from skyair.plans.medallion import FLIGHTS, READINGS, READINGS_VARIANT, audit_source, build, check_source, load_silver, refine
from skyair.plans.models import MODELS
from skyair.schemas import FLIGHTS as FLIGHTS_SCHEMA
from skyair.sources.writers import append_load, write_json_batch


def bronze_readings(spark, lake):
    schema = "sensor_id bigint, period__datetime_from__utc timestamp, value double, parameter string, location_id bigint, location_name string, country string, units string"
    first = [
        (1, at("2026-01-01T10:00:00"), 10.0, "pm25", 1, "Roof", "US", "µg/m³"),
        (1, at("2026-01-01T11:00:00"), 30.0, "pm25", 1, "Roof", "US", "µg/m³"),
        (2, at("2026-01-01T11:00:00"), -1.0, "no2", 1, "Roof", "US", "ppm"),
        (3, at("2026-01-02T11:00:00"), 1.0, None, 1, "Roof", "US", "ppm"),
    ]
    again = [(1, at("2026-01-01T11:00:00"), 50.0, "pm25", 1, "Roof", "US", "µg/m³")]
    append_load(spark.createDataFrame(first, schema), f"{lake}/bronze/readings", "2026-01-01")
    append_load(spark.createDataFrame(again, schema), f"{lake}/bronze/readings", "2026-01-02")


def bronze_flights(spark, lake):
    rows = []
    for icao24, latitude, when, country in [
        ("a", 10.0, "2026-01-01T10:00:00", "US"),
        ("a", 10.0, "2026-01-01T10:00:00", "US"),
        ("a", 11.0, "2026-01-01T12:00:00", "US"),
        ("b", 91.0, "2026-01-01T10:00:00", "US"),
        (None, 10.0, "2026-01-01T10:00:00", "US"),
    ]:
        row = dict.fromkeys(FLIGHTS_SCHEMA.names)
        row.update(icao24=icao24, latitude=latitude, longitude=5.0, observed_at=at(when), origin_country=country, ingested_at=at(when))
        rows.append(tuple(row.values()))
    write_json_batch(spark.createDataFrame(rows, FLIGHTS_SCHEMA), f"{lake}/bronze/flights")
    (spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{lake}/bronze/flights"))


@pytest.fixture
def lake(spark, tmp_path):
    for table in ("readings_processed", "readings_variant_processed", "flights_processed", *(model.name for model in MODELS)):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return str(tmp_path)


def test_bronze_to_marts(spark, lake):
    bronze_readings(spark, lake)
    bronze_flights(spark, lake)
    assert build(spark, lake) == ["daily_summary", "polluted_days", "latest_states", "flight_air_correlation"]
    daily = spark.table("daily_summary").first()
    assert (daily.country, daily.reading_count, daily.avg_value) == ("US", 2, 30.0)
    assert tuples(spark.table("latest_states"), "icao24", "latitude") == [("a", 11.0)]
    row = spark.table("flight_air_correlation").first()
    assert (row.country, row.avg_pm25, row.flight_count) == ("US", 30.0, 1)
    assert spark.table("polluted_days").first().avg_pm25 == 30.0
    silver = spark.table("readings_processed")
    assert "units" in silver.columns and tuples(silver, "value", "event_date")[0][0] == 10.0
    assert tuple(audit_source(spark, lake, READINGS).first()) == (5, 4, 3, 2)
    assert tuple(audit_source(spark, lake, FLIGHTS).first()) == (6, 5, 3, 2)
    # a second run over the same bronze changes nothing
    before = tuples(spark.table("flight_air_correlation"))
    build(spark, lake)
    assert tuples(spark.table("flight_air_correlation")) == before


def test_missing_source_is_skipped(spark, lake):
    bronze_readings(spark, lake)
    assert refine(spark, lake) == ["readings"]
    assert load_silver(spark, lake) == {"readings": "readings_processed"}
    assert build(spark, lake) == ["daily_summary", "polluted_days"]


def test_sources_and_groups_are_chosen(spark, lake):
    bronze_readings(spark, lake)
    bronze_flights(spark, lake)
    assert build(spark, lake, ["flights"]) == ["latest_states"]
    assert build(spark, lake, groups=["correlation"]) == []  # reads a mart that was never built
    assert build(spark, lake, groups=["batch"]) == ["daily_summary", "polluted_days"]
    assert build(spark, lake, groups=["correlation"]) == ["flight_air_correlation"]
    with pytest.raises(ValueError, match="unknown sources"):
        refine(spark, lake, ["weather"])


def test_silver_is_pruned_by_day(spark, lake):
    bronze_readings(spark, lake)
    refine(spark, lake)
    silver = spark.read.parquet(f"{lake}/silver/readings").filter(F.col("event_date") == "2026-01-01")
    assert "PartitionFilters: [isnotnull(event_date" in silver._jdf.queryExecution().toString()
    refine(spark, lake, by_day=False)
    assert spark.read.parquet(f"{lake}/silver/readings").count() == 2


def test_validating_first_keeps_the_good_copy(spark, lake):
    schema = "sensor_id bigint, period__datetime_from__utc timestamp, value double, parameter string, location_id bigint"
    for load, value in (("1", 5.0), ("2", None)):
        rows = [(1, at("2026-01-01"), value, "pm25", 1)]
        append_load(spark.createDataFrame(rows, schema), f"{lake}/bronze/readings", load)
    refine(spark, lake)
    assert spark.read.parquet(f"{lake}/silver/readings").count() == 0
    load_silver(spark, lake)
    assert spark.table("readings_processed").count() == 0
    refine(spark, lake, validate_first=True)
    assert spark.read.parquet(f"{lake}/silver/readings").count() == 1


def test_variant_keeps_the_first_copy_and_passes_its_checks(spark, lake):
    folder = Path(lake) / "bronze" / "readings_variant"
    folder.mkdir(parents=True)
    line = '{{"sensor_id": {}, "location_id": null, "parameter": "pm25", "country": "US", "value": {}, "datetime_from_utc": "{}"}}\n'
    morning, noon = "2026-01-01T06:00:00Z", "2026-01-01T12:00:00Z"
    (folder / "1767225600000.jsonl").write_text(line.format(1, 5.0, morning) + "\n" + line.format(2, -1.0, morning))
    (folder / "1767225700000.jsonl").write_text(
        line.format(1, 7.0, morning) + line.format(2, 1.0, morning) + line.format(1, 8.0, noon) + line.format("null", 1.0, noon)
    )
    assert refine(spark, lake) == ["readings_variant"]
    assert tuples(spark.read.parquet(f"{lake}/silver/readings_variant"), "sensor_id", "value") == [(1, 5.0), (1, 8.0)]
    assert tuple(audit_source(spark, lake, READINGS_VARIANT).first()) == (6, 4, 3, 2)
    load_silver(spark, lake)
    results = check_source(spark, READINGS_VARIANT).collect()
    assert all(row.passed for row in results) and {"has_rows", "unique", "not_null"} <= {row.check_name for row in results}


def test_command_line(spark, lake, capsys):
    bronze_readings(spark, lake)
    run(spark, ["build", lake, "--sources", "readings", "--groups", "batch", "--no-days"])
    run(spark, ["audit", lake, "--sources", "readings"])
    run(spark, ["check", lake])
    out = capsys.readouterr().out
    assert "built: daily_summary polluted_days" in out
    assert "|          5|               4|               3|               2|" in out
    checks = spark.read.json(f"{lake}/checks/readings/checks").filter("check_name = 'non_negative'").first()
    assert (checks.column_name, checks.failures, checks.passed) == ("value", 0, True)
    assert spark.read.json(f"{lake}/checks/readings/breakdown").count() == 1
    with pytest.raises(SystemExit):
        run(spark, ["build", lake, "--sources", "weather"])
