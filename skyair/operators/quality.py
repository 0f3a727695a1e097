"""Data-quality checks on a loaded table (Q1-Q7)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """The table's columns or types differ from the declared ones."""


def _schema_rows(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    rows = []
    for position, (have, want) in enumerate(zip_longest(actual.fields, expected.fields), start=1):
        named = want or have
        rows.append(
            (
                position,
                named.name,
                want.dataType.simpleString() if want else None,
                have.dataType.simpleString() if have else None,
                bool(have and want and have.name == want.name and have.dataType == want.dataType),
            )
        )
    return rows


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Q1: declared against actual columns, in order. Reads metadata only."""
    columns = "position int, column_name string, expected_type string, actual_type string, passed boolean"
    return df.sparkSession.createDataFrame(_schema_rows(df.schema, expected), columns)


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Q1 as a gate: returns ``df``, or raises ``SchemaMismatch`` before any job is started."""
    wrong = [row for row in _schema_rows(df.schema, expected) if not row[-1]]
    if wrong:
        raise SchemaMismatch("; ".join(f"{p}: {n} expected {w}, found {h}" for p, n, w, h, _ in wrong))
    return df


def row_count(df: DataFrame) -> DataFrame:
    """Q2."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], worst: int | None = 20) -> DataFrame:
    """Q3: keys that occur more than once, most frequent first; ``worst=None`` lists all of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).filter(F.col("dup_count") > 1)
    ordered = counts.orderBy(F.col("dup_count").desc(), *keys)
    return ordered if worst is None else ordered.limit(worst)


def duplicate_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q3: how many keys occur more than once, and how many rows they have beyond the first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    extra = F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("extra_rows")
    return counts.agg(F.count(F.lit(1)).alias("duplicate_keys"), extra)


def load_checks(
    df: DataFrame, source: str, keys: Sequence[str], checks: Sequence[tuple[str, str]], expected: T.StructType | None = None
) -> DataFrame:
    """Q1-Q7 of one loaded table as rows (source, check_name, column_name, failures, passed).

    Next to the column checks: ``has_rows`` (one failure if there is none) and ``unique`` (keys that
    occur more than once; ``column_name`` lists them).
    """
    result = column_checks(df, checks, expected)
    empty = row_count(df).select(F.when(F.col("row_count") == 0, 1).otherwise(0).cast("bigint").alias("failures"))
    doubled = duplicate_total(df, keys).select(F.col("duplicate_keys").alias("failures"))
    for name, column, failures in (("has_rows", None, empty), ("unique", ",".join(keys), doubled)):
        passed = (F.col("failures") == 0).alias("passed")
        named = failures.select(F.lit(name).alias("check_name"), F.lit(column).cast("string").alias("column_name"), "failures", passed)
        result = result.unionByName(named)
    return result.select(F.lit(source).alias("source"), "check_name", "column_name", "failures", "passed")


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Q4: number of distinct values per column, ``{output column: column}``, in one scan.

    Spark copies each row once per column and drops repeats in the same map task, so what is shuffled
    is at most the distinct values of every task.
    """
    return df.agg(*(F.countDistinct(column).alias(name) for name, column in columns.items()))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5: number of nulls per column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in columns))


def _failures(check: str, column: str) -> Column:
    """Rows that fail one check. A null fails ``not_null`` only."""
    if check == "not_null":
        return F.count_if(F.col(column).isNull())
    if check == "non_negative":
        return F.count_if(F.col(column) < 0)
    raise ValueError(f"unknown check {check!r}")


def column_checks(
    df: DataFrame, checks: Sequence[tuple[str, str]], expected: T.StructType | None = None
) -> DataFrame:
    """Q6, Q7: one row (check_name, column_name, failures, passed) per (check, column).

    All checks share one aggregate over the table. With ``expected``, the schema check comes along as
    one row per declared column (Q1); a check on a column the table lacks has null failures and has
    not passed.
    """
    results = []
    if expected is not None:
        for _, column, _, _, passed in _schema_rows(df.schema, expected):
            results.append(("schema", column, F.lit(0 if passed else 1).cast("bigint")))
    measured = []
    for check, column in checks:
        name = f"__failures_{len(measured)}"
        known = column in df.columns
        measured.append((_failures(check, column) if known else F.lit(None).cast("bigint")).alias(name))
        results.append((check, column, F.col(name)))
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            failures.alias("failures"),
            F.coalesce(failures == 0, F.lit(False)).alias("passed"),
        )
        for check, column, failures in results
    ]
    totals = df.agg(F.count(F.lit(1)).alias("__rows"), *measured)
    return totals.select(F.inline(F.array(*rows)))
