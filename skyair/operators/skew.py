"""Joins for keys that may hold a large share of all rows, where adaptive execution cannot split them.

A plain join of two shuffled tables is left to the engine: it broadcasts a side by its measured bytes and
splits skewed partitions of inner and left joins. It cannot do that where one side comes straight out of an
aggregate over the join key. There the hot keys, found by that same aggregate, are split: their rows on
the big side are dealt to several salts and their rows on the other side repeated once per salt. No row is
dropped on either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.operators.ranking import spread

# A key is hot from this many rows on and gets a salt for each as many rows.
HOT_ROWS = 1_000_000

_SALT = "__salt"
_SALTS = "__salts"
_ROWS = "__rows"


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: str = _ROWS) -> DataFrame:
    """The hot keys of a (keys, rows) table with the number of salts each is split into.

    There is at most one per HOT_ROWS rows of the counted table.
    """
    salts = F.ceil(F.col(rows) / HOT_ROWS).cast("int")
    return counts.filter(F.col(rows) >= HOT_ROWS).select(*keys, salts.alias(_SALTS))


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"{prefix}{i}" for i in range(len(keys))]
    others = [name for name in df.columns if name not in keys]
    return df.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), *others), names


def _same(left: DataFrame, keys: Sequence[str], right: DataFrame, names: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for key, name in zip(keys, names):
        equal = left[key].eqNullSafe(right[name]) if null_safe else left[key] == right[name]
        condition = condition & equal
    return condition


def _with_salts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    hot, names = _renamed(hot, keys, "__hot_")
    return df.join(hot, _same(df, keys, hot, names, True), "left").drop(*names)


def salted_join(
    big: DataFrame, other: DataFrame, keys: Sequence[str], hot: DataFrame, how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Inner or left join on same-named ``keys``, splitting the ``hot`` ones (see ``hot_keys``)."""
    salt = F.coalesce(spread(big, F.col(_SALTS), keys), F.lit(0))
    dealt = _with_salts(big, keys, hot).withColumn(_SALT, salt).drop(_SALTS)
    repeated = _with_salts(other, keys, hot)
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    repeated = repeated.withColumn("__other_salt", F.explode(every_salt)).drop(_SALTS)
    repeated, names = _renamed(repeated, keys, "__other_")
    condition = _same(dealt, keys, repeated, names, null_safe) & (dealt[_SALT] == repeated["__other_salt"])
    return dealt.join(repeated, condition, how).drop(_SALT, "__other_salt", *names)


def lookup_join(big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join on same-named ``keys``; the engine picks the strategy by measured bytes."""
    other, names = _renamed(other, keys, "__other_")
    return big.join(other, _same(big, keys, other, names, False), how).drop(*names)
