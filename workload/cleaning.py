"""C1-C7."""

from __future__ import annotations

from skyair.functions.predicates import in_range, valid_position, valid_reading
from skyair.operators.cleaning import audit, clean, dedup_first, dedup_newest, dedup_rows, keep_valid, require
from workload.registry import query
from workload.standins import FLIGHTS, GAPPY, flights, gappy_readings, table

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
LINE_REST_DESC = ", ".join(f"{name.strip()} DESC" for name in LINE_REST.split(","))


@query(
    "c1_dedup_newest",
    f"""
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, {LINE_REST}
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_shipdate DESC, {LINE_REST_DESC}) AS rn
          FROM lineitem)
    WHERE rn = 1
    """,
)
def c1(spark, sf_dir):
    return dedup_newest(table(spark, sf_dir, "lineitem"), LINE_KEY, ["l_shipdate"])


@query("c2_dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def c2(spark, sf_dir):
    return dedup_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "c3_dedup_first",
    f"""
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, {LINE_REST}
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {LINE_REST}) AS rn
          FROM lineitem)
    WHERE rn = 1
    """,
)
def c3(spark, sf_dir):
    return dedup_first(table(spark, sf_dir, "lineitem"), LINE_KEY, ["l_shipdate"])


@query(
    "c4_require",
    f"""
    WITH {GAPPY}
    SELECT sensor_id, CAST(period__datetime_from__utc AS VARCHAR) AS period__datetime_from__utc, value, parameter,
           location_id, location_name, country
    FROM gappy WHERE value IS NOT NULL AND parameter IS NOT NULL AND location_id IS NOT NULL
    """,
)
def c4(spark, sf_dir):
    return require(gappy_readings(spark, sf_dir), ["value", "parameter", "location_id"])


@query(
    "c5_range_checks",
    f"""
    WITH {FLIGHTS}
    SELECT sequence, latitude, longitude, true_track FROM flights
    WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND true_track >= 0
    """,
)
def c5(spark, sf_dir):
    rows = keep_valid(flights(spark, sf_dir), valid_position() & in_range("true_track", low=0.0))
    return rows.select("sequence", "latitude", "longitude", "true_track")


_KEYS = ("sensor_id", "period__datetime_from__utc")
_REQUIRED = ("value", "parameter", "location_id", "period__datetime_from__utc")
_SURVIVORS = """
survivors AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, period__datetime_from__utc
          ORDER BY location_name DESC NULLS LAST, value DESC NULLS LAST, parameter DESC NULLS LAST,
                   location_id DESC NULLS LAST, country DESC NULLS LAST) AS rn
        FROM {source})
  WHERE rn = 1)
"""
_COLUMNS = """sensor_id, CAST(period__datetime_from__utc AS VARCHAR) AS period__datetime_from__utc, value, parameter,
           location_id, location_name, country"""
_COMPLETE = "value IS NOT NULL AND parameter IS NOT NULL AND location_id IS NOT NULL"


@query(
    "c6_clean",
    f"""
    WITH {GAPPY}, {_SURVIVORS.format(source="gappy")}
    SELECT {_COLUMNS} FROM survivors WHERE {_COMPLETE} AND value >= 0
    """,
)
def c6(spark, sf_dir):
    return clean(gappy_readings(spark, sf_dir), _KEYS, _REQUIRED, valid_reading(), newest=["location_name"])


@query(
    "c6_clean_validate_first",
    f"""
    WITH {GAPPY}, sound AS (SELECT * FROM gappy WHERE {_COMPLETE} AND value >= 0), {_SURVIVORS.format(source="sound")}
    SELECT {_COLUMNS} FROM survivors
    """,
)
def c6_first(spark, sf_dir):
    rows = gappy_readings(spark, sf_dir)
    return clean(rows, _KEYS, _REQUIRED, valid_reading(), newest=["location_name"], validate_first=True)


@query(
    "c6_clean_keep_first",
    f"""
    WITH {GAPPY}, {_SURVIVORS.format(source="gappy").replace("DESC", "ASC")}
    SELECT {_COLUMNS} FROM survivors WHERE {_COMPLETE} AND value >= 0
    """,
)
def c6_keep_first(spark, sf_dir):
    rows = gappy_readings(spark, sf_dir)
    return clean(rows, _KEYS, _REQUIRED, valid_reading(), newest=["location_name"], keep_first=True)


@query(
    "c7_audit",
    f"""
    WITH {GAPPY}, {_SURVIVORS.format(source="gappy")}
    SELECT (SELECT count(*) FROM gappy) AS rows_before, count(*) AS rows_after_dedup,
           count(*) FILTER (WHERE {_COMPLETE}) AS rows_after_nulls,
           count(*) FILTER (WHERE {_COMPLETE} AND value >= 0) AS rows_after_range
    FROM survivors
    """,
)
def c7(spark, sf_dir):
    return audit(gappy_readings(spark, sf_dir), _KEYS, _REQUIRED, valid_reading(), newest=["location_name"])
