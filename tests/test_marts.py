import math

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, shown_plan, tuples

from skyair.operators.aggregation import breakdown, flight_activity, pivot_mean
from skyair.operators.reporting import (
    headline,
    listing,
    live_cards,
    metric_pairs,
    sample_rows,
    tracked,
    trend,
    with_day_label,
    worst_days,
)
from skyair.plans.marts import CORRELATION_COLUMNS, correlation, daily_summary, latest_states, polluted_days
from skyair.schemas import FLIGHTS

READINGS = "country string, location_id bigint, location_name string, parameter string, period__datetime_from__utc timestamp, value double"


def readings(spark):
    rows = [
        ("US", 1, "Roof", "pm25", at("2026-01-01T23:59:59.999999"), 10.0),
        ("US", 1, "Roof", "pm25", at("2026-01-02T00:00:00"), 20.0),
        ("US", 1, "Roof", "pm25", at("2026-01-02T12:00:00"), 40.0),
        ("US", 2, "Park", "pm25", at("2026-01-02T12:00:00"), 60.0),
        ("US", 2, "Park", "no2", at("2026-01-02T12:00:00"), 0.25),
        (None, 3, None, "pm25", at("2026-01-02T12:00:00"), 1.0),
        ("PK", 4, "Gate", "o3", at("2026-01-05T12:00:00"), 5.0),
    ]
    return spark.createDataFrame(rows, READINGS)


def flight(icao24, country, when, altitude=None, velocity=None, **more):
    row = dict.fromkeys(FLIGHTS.names)
    row.update(icao24=icao24, origin_country=country, observed_at=at(when), baro_altitude=altitude, velocity=velocity, **more)
    return tuple(row[name] for name in FLIGHTS.names)


def flights(spark):
    rows = [
        flight("a", "US", "2026-01-02T01:00:00", 100.0, 10.0),
        flight("a", "US", "2026-01-02T02:00:00", 200.0, None),
        flight("b", "US", "2026-01-02T03:00:00", 600.0, 40.0),
        flight("c", "United Kingdom", "2026-01-02T03:00:00", None, 50.0, callsign="BAW1", on_ground=True),
        flight("d", None, "2026-01-02T03:00:00", 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, FLIGHTS)


def test_daily_summary_splits_at_utc_midnight(spark):
    rows = tuples(daily_summary(readings(spark)).filter("location_id = 1"), "reading_date", "reading_count", "avg_value", "min_value", "max_value")
    assert [(str(d), *rest) for d, *rest in rows] == [("2026-01-01", 1, 10.0, 10.0, 10.0), ("2026-01-02", 2, 30.0, 20.0, 40.0)]


def test_pollutants_average_location_days_not_readings(spark):
    daily = daily_summary(readings(spark))
    row = pivot_mean(daily, ["country", "reading_date"], {"avg_pm25": "pm25", "avg_no2": "no2"}).filter(
        "country = 'US' AND reading_date = '2026-01-02'"
    ).first()
    assert (row.avg_pm25, row.avg_no2) == (45.0, 0.25)  # (30 + 60) / 2, not (20 + 40 + 60) / 3


def test_flight_activity_counts_aircraft_and_averages_observations(spark):
    row = flight_activity(flights(spark)).filter("country = 'US'").first()
    assert (row.flight_count, row.avg_altitude, row.avg_velocity) == (2, 300.0, 25.0)
    assert flight_activity(flights(spark), approximate=0.01).filter("country = 'US'").first().flight_count == 2


def test_correlation_keeps_both_sides(spark):
    mart = correlation(daily_summary(readings(spark)), flights(spark))
    assert tuple(mart.columns) == CORRELATION_COLUMNS
    rows = {(r.country, str(r.reading_date), r.flight_count, r.avg_pm25) for r in mart.collect()}
    assert rows == {
        ("US", "2026-01-01", None, 10.0),
        ("US", "2026-01-02", 2, 45.0),
        ("United Kingdom", "2026-01-02", 1, None),
        ("PK", "2026-01-05", None, None),
        (None, "2026-01-02", None, 1.0),
        (None, "2026-01-02", 1, None),
    }


def test_correlation_with_one_form_of_country(spark):
    names = spark.createDataFrame([("United Kingdom", "US")], "alias string, country string")
    mart = correlation(daily_summary(readings(spark)), flights(spark), countries=names)
    row = mart.filter("country = 'US' AND reading_date = '2026-01-02'").first()
    assert (row.flight_count, row.avg_pm25) == (3, 45.0)


def test_correlation_join_adds_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = correlation(daily_summary(readings(spark)), flights(spark))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4  # summary, pivot, distinct aircraft, activity
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_states(spark):
    out = latest_states(flights(spark))
    assert tuples(out, "icao24", "baro_altitude") == [("a", 200.0), ("b", 600.0), ("c", None), ("d", 1.0)]
    assert tracked(out).first()[0] == 4
    assert [r.icao24 for r in listing(out).collect()] == ["d", "a", "b", "c"]


def test_live_cards(spark):
    cards = {r.icao24: r for r in live_cards(latest_states(flights(spark))).collect()}
    assert cards["c"].title == "BAW1 (United Kingdom)" and cards["a"].title == "a (US)"
    assert (cards["a"].altitude, cards["a"].ground_speed, cards["b"].ground_speed) == ("200", "—", "40.0")
    assert (cards["c"].grounded, cards["a"].grounded) == ("Yes", "No")


def test_worst_days_break_ties_by_key(spark):
    rows = [("US", i, f"L{i}", "pm25", at(f"2026-01-0{1 + i % 3}"), 5.0) for i in range(30)]
    days = polluted_days(daily_summary(spark.createDataFrame(rows, READINGS)))
    assert [r.location_id for r in days.collect()] == list(range(20))
    assert "TakeOrderedAndProject" in shown_plan(days)
    top = with_day_label(worst_days(daily_summary(readings(spark)), n=1)).first()
    assert (top.label, top.avg_pm25) == ("Park (2026-01-02)", 60.0)


def test_headline_lists_parameters_without_readings(spark):
    rows = {r.parameter: r for r in headline(daily_summary(readings(spark))).collect()}
    assert list(rows) == ["pm25", "pm10", "no2", "o3"]
    assert (rows["pm25"].title, rows["pm25"].mean_value, rows["pm25"].shown) == ("PM25", 25.25, "25.2")
    assert (rows["pm10"].mean_value, rows["pm10"].shown, rows["no2"].shown) == (None, "—", "0.2500")


def test_trend_in_date_order(spark):
    out = trend(daily_summary(readings(spark)), "pm25")
    assert [(str(r.reading_date), round(r.mean_value, 6)) for r in out.collect()] == [
        ("2026-01-01", 10.0),
        ("2026-01-02", round((30 + 60 + 1) / 3, 6)),
    ]


def test_breakdown_and_sample(spark):
    rows = tuples(breakdown(readings(spark)).filter("country = 'US' AND parameter = 'pm25'"))
    assert rows == [("US", "pm25", 4, at("2026-01-01T23:59:59.999999"), at("2026-01-02T12:00:00"))]
    assert [r.location_id for r in sample_rows(readings(spark), ["location_id"], 2).collect()] == [1, 1]


def test_metric_pairs_drop_incomplete_rows(spark):
    df = spark.createDataFrame(
        [("US", 2, 300.0, 25.0, 45.0, None, 0.25), ("PK", None, math.nan, 1.0, 5.0, 6.0, None)],
        "country string, flight_count bigint, avg_altitude double, avg_velocity double, avg_pm25 double, avg_pm10 double, avg_no2 double",
    ).withColumn("reading_date", F.lit("2026-01-02").cast("date"))
    assert tuples(metric_pairs(df), "country", "x_metric", "y_metric", "x", "y") == [
        ("PK", "avg_velocity", "avg_pm10", 1.0, 6.0),
        ("US", "avg_altitude", "avg_pm25", 300.0, 45.0),
        ("US", "flight_count", "avg_no2", 2.0, 0.25),
        ("US", "flight_count", "avg_pm25", 2.0, 45.0),
    ]


@pytest.mark.parametrize("build", [lambda r, f: daily_summary(r), lambda r, f: correlation(daily_summary(r), f), lambda r, f: latest_states(f)])
def test_marts_on_empty_input(spark, build):
    assert build(readings(spark).limit(0), flights(spark).limit(0)).count() == 0
