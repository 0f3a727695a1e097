"""J1-J4, A1-A3, L1 and the correlation mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyair.functions.times import as_instant
from skyair.operators.aggregation import flight_activity, pivot_mean
from skyair.operators.joining import (
    conform_country,
    enrich,
    full_join,
    parse_boxes,
    tag_regions,
    unmapped_countries,
)
from skyair.operators.reporting import worst_days
from skyair.operators.shaping import explode_sensors
from skyair.plans.marts import COUNTRY_DAY, correlation, daily_summary
from workload.registry import ORACLES, query, rounded
from workload.standins import FLIGHTS, POLLUTANTS, READINGS, SENSORS, flights, locations, readings, table

DAILY = """
daily AS (
  SELECT country, location_id, location_name, parameter, CAST(period__datetime_from__utc AS DATE) AS reading_date,
         count(*) AS reading_count, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value
  FROM readings GROUP BY ALL)
"""
_POLLUTION = """
  SELECT {country} AS country, reading_date,
         round(avg(avg_value) FILTER (WHERE parameter = 'AF'), 6) AS avg_pm25,
         round(avg(avg_value) FILTER (WHERE parameter = 'NO'), 6) AS avg_pm10,
         round(avg(avg_value) FILTER (WHERE parameter = 'RO'), 6) AS avg_no2,
         round(avg(avg_value) FILTER (WHERE parameter = 'RF'), 6) AS avg_o3
  FROM daily {join} GROUP BY 1, 2"""
_ACTIVITY = """
  SELECT {country} AS country, CAST(observed_at AS DATE) AS reading_date, count(DISTINCT icao24) AS flight_count,
         round(avg(baro_altitude), 6) AS avg_altitude, round(avg(velocity), 6) AS avg_velocity
  FROM flights {join} GROUP BY 1, 2"""
_CORRELATION = """
    WITH {readings}, {daily}, {flights}{extra}, pollution AS ({pollution}), activity AS ({activity})
    SELECT coalesce(p.country, a.country) AS country,
           CAST(coalesce(p.reading_date, a.reading_date) AS VARCHAR) AS reading_date,
           avg_pm25, avg_pm10, avg_no2, avg_o3, flight_count, avg_altitude, avg_velocity
    FROM pollution p FULL JOIN activity a ON p.country = a.country AND p.reading_date = a.reading_date
"""


def correlation_sql(country="{0}", join="", extra=""):
    return _CORRELATION.format(
        readings=READINGS,
        daily=DAILY,
        flights=FLIGHTS,
        extra=extra,
        pollution=_POLLUTION.format(country=country.format("country"), join=join.format("country")),
        activity=_ACTIVITY.format(country=country.format("origin_country"), join=join.format("origin_country")),
    )


_MEANS = (*POLLUTANTS, "avg_altitude", "avg_velocity")


@query(
    "a1_daily_summary",
    f"""
    WITH {READINGS}, {DAILY}
    SELECT country, location_id, location_name, parameter, CAST(reading_date AS VARCHAR) AS reading_date,
           reading_count, round(avg_value, 6) AS avg_value, min_value, max_value
    FROM daily
    """,
)
def a1(spark, sf_dir):
    return rounded(daily_summary(readings(spark, sf_dir)), "avg_value")


@query("a1_daily_summary_zoned", ORACLES["a1_daily_summary"])
def a1_zoned(spark, sf_dir):
    """A1 over zoned timestamps, as silver has them."""
    return rounded(daily_summary(zoned(readings(spark, sf_dir), "period__datetime_from__utc")), "avg_value")


@query(
    "a2_pivot_mean",
    f"""
    WITH {READINGS}, {DAILY}, pollution AS ({_POLLUTION.format(country="country", join="")})
    SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM pollution
    """,
)
def a2(spark, sf_dir):
    return rounded(pivot_mean(daily_summary(readings(spark, sf_dir)), COUNTRY_DAY, POLLUTANTS), *POLLUTANTS)


@query(
    "a3_flight_activity",
    f"""
    WITH {FLIGHTS}, activity AS ({_ACTIVITY.format(country="origin_country", join="")})
    SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM activity
    """,
)
def a3(spark, sf_dir):
    return rounded(flight_activity(flights(spark, sf_dir)), "avg_altitude", "avg_velocity")


@query("a3_flight_activity_zoned", ORACLES["a3_flight_activity"])
def a3_zoned(spark, sf_dir):
    """A3 over zoned timestamps."""
    return rounded(flight_activity(zoned(flights(spark, sf_dir), "observed_at")), "avg_altitude", "avg_velocity")


def zoned(df, name):
    return df.withColumn(name, as_instant(df, name))


@query("j1_correlation", correlation_sql())
def j1(spark, sf_dir):
    daily = daily_summary(readings(spark, sf_dir))
    return rounded(correlation(daily, flights(spark, sf_dir), POLLUTANTS), *_MEANS)


@query(
    "j1_full_join",
    """
    SELECT coalesce(c.country, s.country) AS country, n_customers, n_suppliers
    FROM (SELECT c_nationkey AS country, count(*) AS n_customers FROM customer GROUP BY 1) c
    FULL JOIN (SELECT s_nationkey + 5 AS country, count(*) AS n_suppliers FROM supplier GROUP BY 1) s
      ON c.country = s.country
    """,
)
def j1_plain(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("country"))
    suppliers = table(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") + 5).alias("country"))
    rows = F.count(F.lit(1))
    return full_join(customers.agg(rows.alias("n_customers")), suppliers.agg(rows.alias("n_suppliers")), ["country"])


@query(
    "j2_enrich",
    f"""
    WITH {SENSORS}
    SELECT sensor_id, l_orderkey, l_quantity, country, location_id, location_name, parameter
    FROM (SELECT *, l_suppkey * 10 + l_linenumber AS sensor_id FROM lineitem)
    JOIN sensors USING (sensor_id) WHERE sensor_last IS NOT NULL
    """,
)
def j2(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    measured = items.select(
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("sensor_id"), "l_orderkey", "l_quantity"
    )
    sensors = explode_sensors(locations(spark, sf_dir)).filter("sensor_last IS NOT NULL")
    return enrich(measured, sensors).drop("location_last", "sensor_last")


BOX_TEXT = "north, 0.0, -0.2, 0.3, 0.25 | south,-0.3,-0.25,0.0,0.2|middle,-0.1,-0.1,0.1,0.1"


@query(
    "j3_tag_regions",
    """
    WITH boxes(region, lamin, lomin, lamax, lomax) AS (
      VALUES ('north', 0.0::DOUBLE, -0.2::DOUBLE, 0.3::DOUBLE, 0.25::DOUBLE), ('south', -0.3, -0.25, 0.0, 0.2),
             ('middle', -0.1, -0.1, 0.1, 0.1)),
    points AS (
      SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude FROM embeddings)
    SELECT region, vec_id, latitude, longitude
    FROM points JOIN boxes ON latitude BETWEEN lamin AND lamax AND longitude BETWEEN lomin AND lomax
    """,
)
def j3(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding")[0].cast("double").alias("latitude"),
        F.col("embedding")[1].cast("double").alias("longitude"),
    )
    return tag_regions(points, parse_boxes(spark, BOX_TEXT), cell=0.1)


def country_mapping(spark, sf_dir):
    """Nations of three regions, to be called by their region's name."""
    regions = table(spark, sf_dir, "region").filter("r_regionkey < 3")
    joined = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("n_name").alias("alias"), F.col("r_name").alias("country"))


_MAPPING = ", mapping AS (SELECT n_name AS alias, r_name AS conformed FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 3)"


@query(
    "j4_conform_country",
    f"""
    WITH {READINGS}{_MAPPING}
    SELECT sensor_id, location_id, value, coalesce(conformed, country) AS country
    FROM readings LEFT JOIN mapping ON country = alias
    """,
)
def j4(spark, sf_dir):
    rows = readings(spark, sf_dir).select("sensor_id", "location_id", "value", "country")
    return conform_country(rows, country_mapping(spark, sf_dir))


@query(
    "j4_unmapped_countries",
    f"""
    WITH {READINGS}{_MAPPING}
    SELECT country, count(*) AS row_count FROM readings
    WHERE country NOT IN (SELECT alias FROM mapping) AND country NOT IN (SELECT conformed FROM mapping) GROUP BY ALL
    """,
)
def j4_unmapped(spark, sf_dir):
    return unmapped_countries(readings(spark, sf_dir), country_mapping(spark, sf_dir))


@query(
    "j4_correlation_conformed",
    correlation_sql("coalesce(conformed, {0})", "LEFT JOIN mapping ON {0} = alias", _MAPPING),
)
def j4_correlation(spark, sf_dir):
    daily = daily_summary(readings(spark, sf_dir))
    mart = correlation(daily, flights(spark, sf_dir), POLLUTANTS, country_mapping(spark, sf_dir))
    return rounded(mart, *_MEANS)


@query(
    "l1_polluted_days",
    f"""
    WITH {READINGS}, {DAILY}
    SELECT country, location_id, location_name, CAST(reading_date AS VARCHAR) AS reading_date,
           round(avg_value, 6) AS avg_pm25, reading_count
    FROM daily WHERE parameter = 'AF'
    ORDER BY round(avg_value, 6) DESC, country, location_id, location_name, reading_date LIMIT 20
    """,
)
def l1(spark, sf_dir):
    return worst_days(rounded(daily_summary(readings(spark, sf_dir)), "avg_value"), "AF")
