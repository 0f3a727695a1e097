"""Placement of rows on shards through a permutation-filled lookup table.

Every shard orders the slots of a table of prime size by an offset and a step drawn from its name. The
shards take turns; in its turn a shard claims the first slot of its order that is still free. A key is
placed by hashing it to a slot. Each shard owns the same number of slots, give or take one, and when a
shard is added or leaves, few keys change place.

The table has as many rows as slots, a parameter, so broadcasting it is safe at every input size, and
placing a key is one lookup without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 2039
SHARDS = tuple(f"shard-{k:02d}" for k in range(16))
#: Slots are broadcast, so their number is bounded: about 1 MB.
MAX_SLOTS = 65_537


def _hash(text: Column, first: int) -> Column:
    """60 bits of an MD5 digest, from its hexadecimal place ``first`` on."""
    return F.conv(F.substring(F.md5(text.cast("binary")), first, 15), 16, 10).cast("bigint")


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key counts as empty text."""
    return (_hash(F.coalesce(key.cast("string"), F.lit("")), 1) % slots).cast("int")


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Rows (slot, shard), one for each slot.

    ``shards`` are distinct names, one at least and no more than ``slots``; ``slots`` is a prime.
    """
    if not shards or len(set(shards)) != len(shards) or None in shards:
        raise ValueError("shards must be distinct names, one at least")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    names = F.array(*map(F.lit, shards))
    orders = F.transform(
        names,
        lambda name: F.transform(
            F.sequence(F.lit(0), F.lit(slots - 1)),
            lambda k: ((_hash(name, 1) % slots + k * (_hash(name, 17) % (slots - 1) + 1)) % slots).cast("int"),
        ),
    )
    one = spark.range(1).select(names.alias("names"), orders.alias("orders"))

    def turn(table: Column, t: Column) -> Column:
        shard = (t % len(shards)).cast("int")
        free = F.filter(F.element_at(F.col("orders"), shard + 1), lambda s: F.element_at(table, s + 1) < 0)
        slot = F.element_at(free, 1)
        return F.concat(F.slice(table, F.lit(1), slot), F.array(shard), F.slice(table, slot + 2, F.lit(slots)))

    filled = F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), F.array_repeat(F.lit(-1), slots), turn)
    return one.select("names", F.posexplode(filled).alias("slot", "owner")).select(
        "slot", F.element_at("names", F.col("owner") + 1).alias("shard")
    )


def place(df: DataFrame, table: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """``df`` plus ``slot`` and ``shard``; every row stays, repeated keys share a shard.

    A null key is placed like empty text. Columns of ``df`` named ``slot`` or ``shard`` are replaced. An
    empty ``df`` gives an empty result.
    """
    placed = df.drop(*(c for c in ("slot", "shard") if c != key)).withColumn("__slot", slot_of(F.col(f"`{key}`"), slots))
    found = table.select(F.col("slot").alias("__owned"), F.col("shard").alias("__shard"))
    placed = placed.join(F.broadcast(found), F.col("__slot") == F.col("__owned"), "left").drop("__owned")
    if key in ("slot", "shard"):
        raise ValueError("the key column may not be named like a result")
    return placed.withColumnsRenamed({"__slot": "slot", "__shard": "shard"})


ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, name,
    ('0x' || substr(md5(name), 1, 15))::BIGINT % {SLOTS} AS first,
    ('0x' || substr(md5(name), 17, 15))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM (SELECT range AS i, printf('shard-%02d', range) AS name FROM range({len(SHARDS)}))
), orders AS (
  SELECT list(o ORDER BY i) AS o
  FROM (SELECT i, list_transform(range({SLOTS}), lambda k : (first + k * step) % {SLOTS}) AS o FROM shards)
), fill AS (
  SELECT 0 AS t, list_transform(range({SLOTS}), lambda k : -1::BIGINT) AS owners
  UNION ALL
  SELECT t + 1, list_concat(list_concat(owners[1:slot], [t % {len(SHARDS)}]), owners[slot + 2:])
  FROM (
    SELECT t, owners, list_filter(o[t % {len(SHARDS)} + 1], lambda s : owners[s + 1] < 0)[1] AS slot
    FROM fill, orders WHERE t < {SLOTS}
  )
), filled AS (SELECT owners FROM fill WHERE t = {SLOTS})
SELECT d.doc_id, d.slot::INTEGER AS slot, printf('shard-%02d', owners[d.slot + 1]) AS shard
FROM (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents
) d, filled
"""
