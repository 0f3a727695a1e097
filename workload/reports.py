"""A4-A8, L2, L3 and Q1-Q7."""

from __future__ import annotations

from pyspark.sql import types as T

from skyair.operators.aggregation import breakdown, daily_summary
from skyair.operators.quality import (
    column_checks,
    distinct_counts,
    duplicate_keys,
    null_counts,
    row_count,
)
from skyair.operators.reporting import headline, listing, metric_pairs, sample_rows, tracked, trend
from skyair.operators.selection import latest
from skyair.plans.marts import correlation, latest_states
from skyair.schemas import READINGS_CHECKS
from workload.marts import DAILY, correlation_sql
from workload.registry import query, rounded
from workload.standins import FLIGHTS, GAPPY, POLLUTANTS, READINGS, flights, gappy_readings, readings, table


@query(
    "a4_headline",
    f"""
    WITH {READINGS}, {DAILY}, wanted AS (SELECT unnest(['AF', 'NO', 'zz']) AS parameter)
    SELECT parameter, upper(parameter) AS title, round(mean_value, 6) AS mean_value,
           CASE WHEN mean_value IS NULL THEN '—' WHEN abs(mean_value) < 1 THEN printf('%.4f', mean_value)
                ELSE printf('%.1f', mean_value) END AS shown
    FROM wanted LEFT JOIN (SELECT parameter, avg(avg_value) AS mean_value FROM daily GROUP BY 1) USING (parameter)
    """,
)
def a4(spark, sf_dir):
    return rounded(headline(daily_summary(readings(spark, sf_dir)), ["AF", "NO", "zz"]), "mean_value")


@query(
    "a5_trend",
    f"""
    WITH {READINGS}, {DAILY}
    SELECT CAST(reading_date AS VARCHAR) AS reading_date, round(avg(avg_value), 6) AS mean_value
    FROM daily WHERE parameter = 'RO' GROUP BY 1 ORDER BY 1
    """,
)
def a5(spark, sf_dir):
    return rounded(trend(daily_summary(readings(spark, sf_dir)), "RO"), "mean_value")


@query("a6_tracked", f"WITH {FLIGHTS} SELECT count(DISTINCT icao24) AS aircraft_tracked FROM flights")
def a6(spark, sf_dir):
    return tracked(latest_states(flights(spark, sf_dir)))


@query(
    "a7_breakdown",
    f"""
    WITH {READINGS}
    SELECT country, parameter, count(*) AS measurement_count,
           CAST(min(period__datetime_from__utc) AS VARCHAR) AS earliest_reading,
           CAST(max(period__datetime_from__utc) AS VARCHAR) AS latest_reading
    FROM readings GROUP BY ALL
    """,
)
def a7(spark, sf_dir):
    return breakdown(readings(spark, sf_dir))


_PAIRS = """
    SELECT country, reading_date, '{x}' AS x_metric, '{y}' AS y_metric,
           CAST({x} AS DOUBLE) AS x, {y} AS y FROM mart WHERE {x} IS NOT NULL AND {y} IS NOT NULL
"""


@query(
    "a8_metric_pairs",
    f"WITH mart AS ({correlation_sql()})"
    + "UNION ALL".join(
        _PAIRS.format(x=x, y=y)
        for x, y in (
            ("flight_count", "avg_pm25"),
            ("avg_altitude", "avg_pm25"),
            ("avg_velocity", "avg_pm10"),
            ("flight_count", "avg_no2"),
        )
    ),
)
def a8(spark, sf_dir):
    mart = correlation(daily_summary(readings(spark, sf_dir)), flights(spark, sf_dir), POLLUTANTS)
    return rounded(metric_pairs(mart), "x", "y")


@query(
    "l2_sample_rows",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate
    FROM orders ORDER BY o_orderkey, o_custkey LIMIT 10
    """,
)
def l2(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return sample_rows(rows, ["o_orderkey", "o_custkey"])


@query(
    "l3_listing",
    f"""
    WITH {FLIGHTS}
    SELECT origin_country, icao24, CAST(observed_at AS VARCHAR) AS observed_at, sequence
    FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, sequence DESC) AS rn FROM flights)
    WHERE rn = 1 ORDER BY origin_country, icao24
    """,
)
def l3(spark, sf_dir):
    newest = latest(flights(spark, sf_dir), ["icao24"], "observed_at", ["sequence"])
    return listing(newest.select("origin_country", "icao24", "observed_at", "sequence"))


# Readings as the test tables type them
GAPPY_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("period__datetime_from__utc", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

_CHECKS = f"""
    WITH {GAPPY}, failed AS (
      SELECT 'not_null' AS check_name, 'sensor_id' AS column_name, count(*) FILTER (WHERE sensor_id IS NULL) AS failures FROM gappy
      UNION ALL SELECT 'not_null', 'parameter', count(*) FILTER (WHERE parameter IS NULL) FROM gappy
      UNION ALL SELECT 'not_null', 'value', count(*) FILTER (WHERE value IS NULL) FROM gappy
      UNION ALL SELECT 'non_negative', 'value', count(*) FILTER (WHERE value < 0) FROM gappy
      UNION ALL SELECT 'not_null', 'country', count(*) FILTER (WHERE country IS NULL) FROM gappy
      {{schema}})
    SELECT check_name, column_name, failures, failures = 0 AS passed FROM failed
"""


@query(
    "q1_schema_with_column_checks",
    _CHECKS.format(
        schema="UNION ALL SELECT 'schema', column_name, CASE WHEN column_name = 'value' THEN 1 ELSE 0 END"
        " FROM (DESCRIBE gappy)"
    ),
)
def q1(spark, sf_dir):
    """One column is declared with a wrong type, to be reported."""
    wrong = T.StructType(
        [T.StructField(f.name, T.FloatType() if f.name == "value" else f.dataType) for f in GAPPY_SCHEMA.fields]
    )
    return column_checks(gappy_readings(spark, sf_dir), READINGS_CHECKS, wrong)


@query("q2_row_count", f"WITH {READINGS} SELECT count(*) AS row_count FROM readings")
def q2(spark, sf_dir):
    return row_count(readings(spark, sf_dir))


@query(
    "q3_duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY ALL HAVING count(*) > 1
    ORDER BY dup_count DESC, l_orderkey, l_linenumber LIMIT 20
    """,
)
def q3(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q4_distinct_counts",
    f"""
    WITH {GAPPY}
    SELECT count(DISTINCT location_id) AS distinct_locations, count(DISTINCT sensor_id) AS distinct_sensors FROM gappy
    """,
)
def q4(spark, sf_dir):
    columns = {"distinct_locations": "location_id", "distinct_sensors": "sensor_id"}
    return distinct_counts(gappy_readings(spark, sf_dir), columns)


@query(
    "q5_null_counts",
    f"""
    WITH {GAPPY}
    SELECT count(*) FILTER (WHERE value IS NULL) AS null_value_count,
           count(*) FILTER (WHERE sensor_id IS NULL) AS null_sensor_id_count,
           count(*) FILTER (WHERE location_id IS NULL) AS null_location_id_count
    FROM gappy
    """,
)
def q5(spark, sf_dir):
    return null_counts(gappy_readings(spark, sf_dir), ["value", "sensor_id", "location_id"])


@query("q6_q7_column_checks", _CHECKS.format(schema=""))
def q6(spark, sf_dir):
    return column_checks(gappy_readings(spark, sf_dir), READINGS_CHECKS)
