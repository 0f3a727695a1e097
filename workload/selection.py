"""W1-W5."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyair.operators.joining import enrich
from skyair.operators.selection import (
    active_locations,
    backfill_from,
    backfill_tail,
    backfill_window,
    covering_locations,
    latest,
    newest_rows,
)
from workload.registry import query
from workload.standins import EVENT_SENSORS, event_sensors, table

TARGETS = ("click_0", "view_0", "view_1", "purchase_2")
EVENT = "event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props"


@query(
    "w1_latest",
    f"""
    SELECT {EVENT}
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def w1(spark, sf_dir):
    return latest(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


_SINCE = "date_trunc('second', max(ts) OVER (PARTITION BY user_id, event_type) - INTERVAL 7 DAY)"


@query(
    "w2_backfill_window",
    f"SELECT {EVENT} FROM (SELECT *, {_SINCE} AS since FROM events) WHERE ts >= since",
)
def w2(spark, sf_dir):
    return backfill_window(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 7)


@query(
    "w2_backfill_from_metadata",
    """
    SELECT l_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate >= o_orderdate - INTERVAL 7 DAY
    """,
)
def w2_metadata(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey")
    joined = enrich(table(spark, sf_dir, "lineitem"), orders, "l_orderkey")
    rows = backfill_from(joined, "l_shipdate", "o_orderdate", 7)
    return rows.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate")


@query(
    "w3_newest_rows",
    f"""
    SELECT {EVENT}
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 15
    """,
)
def w3(spark, sf_dir):
    return newest_rows(table(spark, sf_dir, "events"), ["user_id"], "ts", 15, ["event_id"])


@query(
    "w3_newest_rows_above_pruning_limit",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_partkey, l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn
          FROM lineitem)
    WHERE rn <= 1500
    """,
)
def w3_many(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    tiebreak = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rows = newest_rows(items, ["l_returnflag"], "l_shipdate", 1500, tiebreak)
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


@query(
    "w2_w3_backfill_tail",
    f"""
    SELECT {EVENT}
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
          FROM (SELECT *, {_SINCE} AS since FROM events) WHERE ts >= since)
    WHERE rn <= 5
    """,
)
def w2_w3(spark, sf_dir):
    return backfill_tail(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 7, 5, ["event_id"])


@query(
    "w4_active_locations",
    f"""
    WITH {EVENT_SENSORS}
    SELECT country, location_id, CAST(location_last AS VARCHAR) AS location_last
    FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY location_last DESC NULLS LAST, location_id) AS rn
          FROM (SELECT DISTINCT country, location_id, location_last FROM event_sensors
                WHERE parameter IN {TARGETS}))
    WHERE rn <= 3
    """,
)
def w4(spark, sf_dir):
    return active_locations(event_sensors(spark, sf_dir), TARGETS, 3)


@query(
    "w5_covering_locations",
    f"""
    WITH {EVENT_SENSORS},
    candidates AS (SELECT * FROM event_sensors WHERE parameter IN {TARGETS}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY country, parameter
                                   ORDER BY location_last DESC NULLS LAST, location_id) = 1 AS first_for
      FROM candidates),
    novelty AS (
      SELECT country, location_id, location_last, bool_or(first_for) AS adds_parameter FROM ranked GROUP BY ALL)
    SELECT country, location_id, CAST(location_last AS VARCHAR) AS location_last, adds_parameter
    FROM (SELECT *, row_number() OVER (PARTITION BY country
            ORDER BY adds_parameter DESC, location_last DESC NULLS LAST, location_id) AS rn FROM novelty)
    WHERE rn <= 3
    """,
)
def w5(spark, sf_dir):
    return covering_locations(event_sensors(spark, sf_dir), TARGETS, 3)
