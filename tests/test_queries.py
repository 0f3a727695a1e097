"""Every registered query against its SQL in DuckDB, and the driver contract."""

import inspect

import duckdb
import pytest

import __spark_entry__ as contract
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    expected = canonical([column[0] for column in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(row) for row in df.collect()]) == expected
    assert expected[1], "a query without rows proves nothing"


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 20
    assert rows[0].asDict().keys() == {"country", "location_id", "location_name", "reading_date", "avg_pm25", "reading_count"}


def test_every_query_has_sql_and_reads_tables():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    for query in contract.queries().values():
        assert list(inspect.signature(query).parameters) == ["spark", "sf_dir"]
