"""Top rows per key, safe for keys that hold a large share of all rows.

Spark prunes ``row_number() <= n`` inside each map task before the shuffle (WindowGroupLimit), so a key
sends at most n rows per map task. For n above 1 that can still be many for one task, so the ranking runs
twice, first per key and salt, then per key on what is left. Above a session threshold the pruning is off;
then the rows of a key are dealt by content in two steps of salts before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# With pruning, a salt gathers n rows from each of its map tasks and passes n on.
TASK_SALTS = 4096
# Without, a salt of the first step gathers a millionth of a key.
CONTENT_SALTS = (1 << 20, 1 << 10)
_RANK = "__rank"
_SALT = "__salt"
_PRUNING_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def spread(df: DataFrame, salts: Column | int, keys: Sequence[str] = ()) -> Column:
    """Salt from the input partition and the columns other than ``keys``.

    A task that is run again salts its rows as before, and rows that an earlier shuffle brought together
    by key are spread as well.
    """
    others = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in keys and _hashable(f.dataType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *others), F.lit(salts))


def _hashable(kind: T.DataType) -> bool:
    return _orderable(kind)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    return True


def tiebreak_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Every other column that can be ordered: ranking by all of them leaves only equal rows tied."""
    return [f.name for f in df.schema.fields if f.name not in used and _orderable(f.dataType)]


def newest_first(df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] | None = None):
    """Descending order by ``newest``, then by ``tiebreak`` (default: all other columns), nulls last."""
    rest = tiebreak_columns(df, [*keys, *newest]) if tiebreak is None else list(tiebreak)
    return [F.col(name).desc_nulls_last() for name in [*newest, *rest]]


def oldest_first(df: DataFrame, keys: Sequence[str], oldest: Sequence[str], tiebreak: Sequence[str] | None = None):
    """Ascending order by ``oldest``, then by ``tiebreak`` (default: all other columns), nulls last."""
    rest = tiebreak_columns(df, [*keys, *oldest]) if tiebreak is None else list(tiebreak)
    return [F.col(name).asc_nulls_last() for name in [*oldest, *rest]]


def _keep_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key in the given order; null keys form one group."""
    if n > 1:
        if n <= int(df.sparkSession.conf.get(_PRUNING_LIMIT, "1000")):
            # By task: each task has one salt per key, so the pruning keeps n rows per key and task.
            steps = [F.pmod(F.spark_partition_id(), F.lit(TASK_SALTS))]
        else:
            steps = [spread(df, CONTENT_SALTS[0], keys), *(F.pmod(F.col(_SALT), F.lit(s)) for s in CONTENT_SALTS[1:])]
        for salt in steps:
            df = _keep_ranked(df.withColumn(_SALT, salt), [*keys, _SALT], order, n)
        df = df.drop(_SALT)
    return _keep_ranked(df, keys, order, n)
