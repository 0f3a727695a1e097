"""Deduplication, required columns, range checks, rejects by reason and the row audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyair.operators import skew
from skyair.operators.ranking import TASK_SALTS, newest_first, oldest_first, top_per_key

REASON = "reason"
KEPT, DUPLICATE, MISSING, OUT_OF_RANGE, CORRUPT_LINE = "kept", "duplicate", "missing", "out_of_range", "corrupt"
_FAULT, _LEADS, _SALT, _RANK = "__fault", "__leads", "__salt", "__rank"
#: Keys are counted by this many hashes, to see whether any can be hot.
KEY_HASHES = 1 << 14


class MissingColumns(ValueError):
    """A column the operator needs is not in the input."""


def _check_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; input has {df.columns}")


def dedup_newest(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the one that is newest; remaining ties go to the largest other columns.

    Ranking by all columns ties only equal rows, so the survivor never depends on partitioning. Where
    ``newest`` is already unique within a key, pass ``tiebreak=()`` and no other column is compared.
    """
    _check_columns(df, [*keys, *newest])
    return top_per_key(df, keys, newest_first(df, keys, newest, tiebreak))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are equal in every column."""
    return df.dropDuplicates()


def dedup_first(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the one that arrived first by the ``arrival`` columns."""
    _check_columns(df, [*keys, *arrival])
    return top_per_key(df, keys, oldest_first(df, keys, arrival, tiebreak))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4: drop rows where any of the columns is null (or NaN)."""
    _check_columns(df, columns)
    return df.na.drop(subset=list(columns))


def keep_valid(df: DataFrame, valid: Column) -> DataFrame:
    """Keep rows that satisfy the range predicate (see ``functions.predicates``)."""
    return df.filter(valid)


def _survivors(
    df: DataFrame,
    keys: Sequence[str] | None,
    newest: Sequence[str],
    first: bool,
    tiebreak: Sequence[str] | None,
) -> DataFrame:
    if not keys:
        return dedup_rows(df)
    return dedup_first(df, keys, newest, tiebreak) if first else dedup_newest(df, keys, newest, tiebreak)


def clean(
    df: DataFrame,
    keys: Sequence[str] | None,
    required: Sequence[str],
    valid: Column | None = None,
    newest: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
    keep_first: bool = False,
    validate_first: bool = False,
) -> DataFrame:
    """Deduplicate, then drop incomplete rows, then drop rows out of range.

    In this order a key is lost when its surviving copy is bad although another copy was good.
    ``validate_first`` filters before the dedup: nothing good is lost, and both filters reach the scan.
    ``keys=None`` compares whole rows. A missing column raises ``MissingColumns``.
    """
    _check_columns(df, [*(keys or ()), *required, *newest])

    def filtered(rows: DataFrame) -> DataFrame:
        rows = require(rows, required)
        return rows if valid is None else keep_valid(rows, valid)

    if validate_first:
        return _survivors(filtered(df), keys, newest, keep_first, tiebreak)
    return filtered(_survivors(df, keys, newest, keep_first, tiebreak))


def _complete(df: DataFrame, required: Sequence[str]) -> Column:
    complete = F.lit(True)
    for name in required:
        present = F.col(name).isNotNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            present = present & ~F.isnan(name)
        complete = complete & present
    return complete


def fault_of(df: DataFrame, required: Sequence[str], valid: Column | None = None, corrupt: str | None = None) -> Column:
    """Why a row on its own cannot stay (``corrupt``, ``missing``, ``out_of_range``); null if it can."""
    broken = F.col(corrupt).isNotNull() if corrupt in df.columns else F.lit(False)
    fault = F.when(broken, CORRUPT_LINE).when(~_complete(df, required), MISSING)
    return fault if valid is None else fault.when(~valid, OUT_OF_RANGE)


def may_have_hot_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key may hold ``skew.HOT_ROWS`` rows or more; False is certain.

    Rows are counted by a hash of the key, so no key has more rows than its hash. The counts combine on the map
    side: a task sends one number per hash, and only the key columns are read.
    """
    hashed = F.pmod(F.xxhash64(*keys), F.lit(KEY_HASHES)).alias("hash")
    counts = df.groupBy(hashed).agg(F.count(F.lit(1)).alias("rows"))
    return not counts.filter(F.col("rows") >= skew.HOT_ROWS).isEmpty()


def route(
    df: DataFrame,
    keys: Sequence[str] | None,
    required: Sequence[str],
    valid: Column | None = None,
    newest: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
    keep_first: bool = False,
    validate_first: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """C6 and C7 in one pass: every row of ``df`` and its ``reason``.

    The rows that are ``kept`` are those of ``clean``; all others say why they are not: ``duplicate``,
    ``missing``, ``out_of_range``, or ``corrupt`` where the column of that name holds a line's text. Such
    lines have no key and take no part in the dedup. No row may be pruned. Where a key may be hot, its copies
    are ranked per input partition first, and only its best row of each meets the others; one small job finds
    out. Otherwise the rows are shuffled once.
    """
    _check_columns(df, [*(keys or ()), *required, *newest])
    keys = list(keys) if keys else [name for name in df.columns if name != corrupt]
    broken = F.col(corrupt).isNotNull() if corrupt in df.columns else F.lit(False)
    competes = F.col(_FAULT).isNull() if validate_first else ~broken
    order = (oldest_first if keep_first else newest_first)(df, keys, newest, tiebreak)
    rows = df.withColumn(_FAULT, fault_of(df, required, valid, corrupt)).withColumn(_LEADS, competes)
    rows = rows.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(TASK_SALTS)))

    def ranked(rows: DataFrame, salt: Column) -> DataFrame:
        # Without columns to order by, only equal rows meet.
        window = Window.partitionBy(*keys, _LEADS, salt).orderBy(*(order or [F.lit(0)]))
        return rows.withColumn(_RANK, F.row_number().over(window))

    if may_have_hot_keys(df, keys):
        rows = ranked(rows, F.col(_SALT)).withColumn(_LEADS, F.col(_LEADS) & (F.col(_RANK) == 1))
    rows = ranked(rows, F.when(~F.col(_LEADS), F.col(_SALT)))
    survives = F.col(_LEADS) & (F.col(_RANK) == 1)
    reason = F.when(survives, F.coalesce(F.col(_FAULT), F.lit(KEPT))).when(competes, DUPLICATE).otherwise(F.col(_FAULT))
    return rows.withColumn(REASON, reason).drop(_FAULT, _LEADS, _SALT, _RANK)


def audit_of(counts: DataFrame) -> DataFrame:
    """C7 from counts (reason, rows) of what ``route`` gave: the row that ``audit`` works out from bronze.

    Corrupt lines leave with the incomplete rows; all of them are counted, as they are no copies.
    """
    rows = lambda *reasons: F.coalesce(F.sum(F.when(F.col(REASON).isin(*reasons), F.col("rows"))), F.lit(0)).cast("bigint")
    stages = {
        "rows_before": (KEPT, OUT_OF_RANGE, MISSING, CORRUPT_LINE, DUPLICATE),
        "rows_after_dedup": (KEPT, OUT_OF_RANGE, MISSING, CORRUPT_LINE),
        "rows_after_nulls": (KEPT, OUT_OF_RANGE),
        "rows_after_range": (KEPT,),
    }
    return counts.agg(*(rows(*reasons).alias(name) for name, reasons in stages.items()))


def audit(
    df: DataFrame,
    keys: Sequence[str] | None,
    required: Sequence[str],
    valid: Column | None = None,
    newest: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
    keep_first: bool = False,
) -> DataFrame:
    """One row with the row counts before and after each cleaning step.

    Two aggregates, no join: the input count needs no column (parquet answers it from its footers), and
    the three later counts come from one pass over the dedup survivors. Counts are not taken as
    observed metrics of the write: a map stage that is run again after losing an executor would report
    its rows twice.
    """
    _check_columns(df, [*(keys or ()), *required, *newest])
    complete = _complete(df, required)
    sound = complete if valid is None else complete & valid

    def stages(before, dedup, nulls, ranges):
        names = ("rows_before", "rows_after_dedup", "rows_after_nulls", "rows_after_range")
        counts = (before, dedup, nulls, ranges)
        return [c.cast("bigint").alias(n) for n, c in zip(names, counts)]

    zero, rows = F.lit(0), F.count(F.lit(1))
    before = df.agg(*stages(rows, F.max(zero), F.max(zero), F.max(zero)))
    after = _survivors(df, keys, newest, keep_first, tiebreak).agg(
        *stages(F.max(zero), rows, F.count_if(complete), F.count_if(sound))
    )
    both = before.union(after)
    return both.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in both.columns))
