"""P1-P11."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyair.functions.text import blank_to_null, concentration
from skyair.functions.times import as_instant, days_before, format_utc, from_epoch, parse_utc
from skyair.operators.reporting import live_cards, with_day_label
from skyair.operators.shaping import explode_sensors, flatten, reporting_sensors, target_parameters, unpack_states
from skyair.plans.marts import daily_summary, latest_states
from workload.registry import query, rounded
from workload.standins import FLIGHTS, READINGS, SENSORS, flights, locations, payloads, readings, table


@query(
    "p1_flatten",
    """
    SELECT event_id, value AS reading__value, ts AS period__datetime_from__utc,
           event_type AS period__datetime_from__event_type, user_id
    FROM (SELECT event_id, value, CAST(ts AS VARCHAR) AS ts, event_type, user_id FROM events)
    """,
)
def p1(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("eventId"),
        F.struct(F.col("value").alias("Value")).alias("reading"),
        F.struct(F.struct(F.col("ts").alias("utc"), F.col("event_type").alias("eventType")).alias("datetimeFrom")).alias(
            "period"
        ),
        F.col("user_id").alias("user-id"),
    )
    return flatten(nested)


@query(
    "p2_unpack_states",
    r"""
    WITH sound AS (SELECT *, to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS at_time FROM events WHERE event_type <> 'error')
    SELECT event_id, CAST(user_id AS VARCHAR) AS icao24, event_type AS callsign, 'Nowhere' AS origin_country,
           value AS longitude, -12.5::DOUBLE AS latitude, NULL::DOUBLE AS baro_altitude, TRUE AS on_ground,
           event_id + 0.5::DOUBLE AS velocity, 90.0::DOUBLE AS true_track, -1.25::DOUBLE AS vertical_rate,
           NULL::DOUBLE AS geo_altitude, '0042' AS squawk, CAST(at_time AS VARCHAR) AS observed_at
    FROM sound
    UNION ALL
    SELECT event_id, 'x' || user_id, NULL, 'Nowhere', 3.5, 4.5, 100.0, FALSE, NULL, NULL, NULL, NULL, NULL,
           CAST(at_time AS VARCHAR)
    FROM sound
    """,
)
def p2(spark, sf_dir):
    raw = payloads(table(spark, sf_dir, "events"))
    return unpack_states(raw, keep=["event_id"]).drop("ingested_at")


@query(
    "p3_blank_to_null",
    r"""
    SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS callsign FROM events
    """,
)
def p3(spark, sf_dir):
    kept = F.col("event_type").isin("click", "view")
    padded = F.concat(F.lit(" \t"), F.when(kept, F.col("event_type")).otherwise(""), F.lit("\n  "))
    return table(spark, sf_dir, "events").select("event_id", blank_to_null(padded).alias("callsign"))


@query(
    "p4_event_time",
    "SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS observed_at, TRUE AS stamped FROM events",
)
def p4(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    seconds = F.unix_seconds(as_instant(events, "ts"))
    return events.select(
        "event_id",
        from_epoch(seconds).alias("observed_at"),
        (F.current_timestamp() > from_epoch(seconds)).alias("stamped"),
    )


@query(
    "p5_time_text",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS shown,
           CAST(o_orderdate - INTERVAL 7 DAY AS VARCHAR) AS week_before,
           o_orderstatus <> 'P' AS readable
    FROM orders
    """,
)
def p5(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    shown = orders.withColumn("shown", format_utc(orders, "o_orderdate"))
    again = shown.withColumn("again", parse_utc(F.col("shown")))
    spoiled = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(F.col("shown"))
    return again.select(
        "o_orderkey",
        "shown",
        days_before(again, "again", 7).alias("week_before"),
        parse_utc(spoiled).isNotNull().alias("readable"),
    )


@query(
    "p6_target_parameters",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'N')",
)
def p6(spark, sf_dir):
    kept = target_parameters(table(spark, sf_dir, "lineitem"), ["A", "N"], "l_returnflag")
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query(
    "p7_reporting_sensors",
    f"""
    WITH {SENSORS}
    SELECT country, location_id, location_name, CAST(location_last AS VARCHAR) AS location_last, sensor_id,
           parameter, CAST(sensor_last AS VARCHAR) AS sensor_last
    FROM sensors WHERE sensor_last IS NOT NULL
    """,
)
def p7(spark, sf_dir):
    return reporting_sensors(explode_sensors(locations(spark, sf_dir)))


@query(
    "p8_day_labels",
    f"""
    WITH {READINGS}
    SELECT location_id, reading_date::VARCHAR AS reading_date, avg_pm25,
           location_name || ' (' || CAST(reading_date AS VARCHAR) || ')' AS label
    FROM (SELECT country, location_id, location_name, CAST(period__datetime_from__utc AS DATE) AS reading_date,
                 round(avg(value), 6) AS avg_pm25
          FROM readings WHERE parameter = 'AF' GROUP BY ALL)
    """,
)
def p8(spark, sf_dir):
    daily = rounded(daily_summary(readings(spark, sf_dir)), "avg_value")
    days = daily.filter(F.col("parameter") == "AF").withColumnRenamed("avg_value", "avg_pm25")
    labelled = with_day_label(days)
    return labelled.select("location_id", "reading_date", "avg_pm25", "label")


@query(
    "p9_concentrations",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount,
           CASE WHEN x IS NULL THEN '—' WHEN abs(x) < 1 THEN printf('%.4f', x) ELSE printf('%.1f', x) END AS shown
    FROM (SELECT *, nullif(l_discount - 0.05, 0.05) * l_quantity / 4 AS x FROM lineitem)
    """,
)
def p9(spark, sf_dir):
    shifted = F.nullif(F.col("l_discount") - 0.05, F.lit(0.05)) * F.col("l_quantity") / 4
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", concentration(shifted).alias("shown")
    )


@query(
    "p10_live_cards",
    f"""
    WITH {FLIGHTS}
    SELECT icao24, origin_country, coalesce(callsign, icao24) || ' (' || origin_country || ')' AS title,
           printf('%.0f', baro_altitude) AS altitude, coalesce(printf('%.1f', velocity), '—') AS ground_speed,
           printf('%.0f', true_track) AS heading, printf('%.1f', vertical_rate) AS climb,
           CASE WHEN on_ground THEN 'Yes' ELSE 'No' END AS grounded
    FROM flights
    """,
)
def p10(spark, sf_dir):
    return live_cards(flights(spark, sf_dir))


@query(
    "p11_latest_projection",
    f"""
    WITH {FLIGHTS}
    SELECT region, icao24, callsign, origin_country, longitude, latitude, baro_altitude, geo_altitude, on_ground,
           velocity, true_track, vertical_rate, CAST(observed_at AS VARCHAR) AS observed_at
    FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, region DESC,
                 callsign DESC NULLS LAST, origin_country DESC, longitude DESC, latitude DESC, baro_altitude DESC) AS rn
          FROM flights)
    WHERE rn = 1
    """,
)
def p11(spark, sf_dir):
    return latest_states(flights(spark, sf_dir))
