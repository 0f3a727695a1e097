"""Benchmark decontamination: fingerprints of item-sized windows, found by Hamming distance, then verified.

A text's shingles are runs of five words (lower-cased; one shingle of all words if there are fewer). For
every item, windows with as many shingles as the item has are compared with it. A window and an item each
get a 64-bit SimHash of their shingles, every occurrence counting. The fingerprints are cut into
``RADIUS`` + 1 blocks; two fingerprints within ``RADIUS`` bits agree in at least one whole block, so a join
on (size, block number, block) finds all of them. What is found is verified by the exact similarity
of the two bags of shingles: the sum of the smaller counts over the sum of the larger ones.

A window whose first shingle is no shingle of an item of its size cannot be better than one further right
that begins with one, or than the last window of the text, so only those are fingerprinted. At exactly
0.8 two fingerprints differ in 9.7 bits on average (deviation 2.9), so the radius loses about one window
in 5,000 there and fewer above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import stored

WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BITS = 64
#: Item shingles, and hashes of texts with a hit, are broadcast up to this many rows of 12 bytes; beyond that the
#: join is left to the engine.
BROADCAST_SHINGLES = 500_000

_SPACES = r"[\x20\x09-\x0D]+"


def shingles(text: Column) -> Column:
    """Hashes of all runs of WORDS words, in order; empty if there is no word."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACES), "")

    def runs(own: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(own) - WORDS, F.lit(0)))
        hashed = F.transform(places, lambda i: F.xxhash64(*(F.get(own, i + k) for k in range(WORDS))))
        return F.when(F.size(own) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    # Bound to a lambda variable, the words are split once and not once per run.
    return F.element_at(F.transform(F.array(words), runs), 1)


def fingerprint(bag: Column) -> Column:
    """SimHash: bit b is set if more than half of the values have it set."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(bag, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(1).cast("int"))
        return F.when(ones * 2 > F.size(bag), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(
            F.lit(0).cast("bigint")
        )

    bits = F.sequence(F.lit(0), F.lit(BITS - 1))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda whole, b: whole.bitwiseOR(bit(b)))


def blocks(print_: Column, radius: int = RADIUS) -> Column:
    """The blocks of a fingerprint as (number, value); any two within ``radius`` share one."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("number"),
                F.shiftrightunsigned(print_, low).bitwiseAND((1 << (high - low)) - 1).alias("value"),
            )
            for k, (low, high) in enumerate(zip(edges, edges[1:]))
        )
    )


def similarity(one: Column, two: Column) -> Column:
    """Exact similarity of two bags."""
    count = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    plain = (F.size(F.array_distinct(one)) == F.size(one)) | (F.size(F.array_distinct(two)) == F.size(two))
    counted = F.aggregate(
        F.array_distinct(two), F.lit(0), lambda n, x: n + F.least(count(one, x), count(two, x))
    )
    both = F.when(plain, F.size(F.array_intersect(one, two))).otherwise(counted)
    return both / (F.size(one) + F.size(two) - both)


def contaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", least: float = SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """Rows (key, item, ``window``, ``similarity``): every text and item with a window of ``least`` or more.

    ``window`` is the number of the first word of the best window; of equal ones, the first that begins with
    a shingle of the benchmark. A text shorter than an item is compared as a whole. Null and empty texts and items match nothing; rows with a null
    key are reported with it; repeated rows, and rows that share a key, are reported once per key and item,
    with their best window. Other columns are ignored.
    """
    items = (
        benchmark.select(F.col(f"`{item}`").alias("item"), shingles(F.col(f"`{item_text}`")).alias("bag"))
        .distinct()
        .filter(F.size("bag") > 0)
        .withColumn("size", F.size("bag"))
    )
    starts = items.select("size", F.explode("bag").alias("shingle")).distinct()
    if starts.count() <= BROADCAST_SHINGLES:
        starts = F.broadcast(starts)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = df.select(F.col(f"`{key}`").alias("key"), body.alias("text"))
    at = texts.select(F.xxhash64("text").alias("hash"), F.posexplode(shingles(F.col("text"))).alias("at", "shingle"))
    hits = at.join(starts, "shingle").groupBy("hash").agg(F.collect_set(F.struct("at", "size")).alias("hits"))
    hits = stored(hits, "benchmark-hits")  # next to a plain scan the engine can split a large group of copies
    held = texts.withColumn("hash", F.xxhash64("text"))
    if hits.count() <= BROADCAST_SHINGLES:  # then only texts that hold a hit are shuffled
        held = held.join(F.broadcast(hits.select("hash")), "hash", "left_semi")
    held = held.join(hits, "hash").distinct()
    held = held.select("key", "hits", shingles(F.col("text")).alias("all"))
    last = lambda size: F.greatest(F.size("all") - size, F.lit(0))
    begins = F.array_distinct(
        F.transform("hits", lambda h: F.struct(F.least(h["at"], last(h["size"])).alias("at"), h["size"].alias("size")))
    )
    windows = held.select("key", "all", F.explode(begins).alias("begin")).select(
        "key", F.col("begin.at").alias("window"), F.col("begin.size").alias("size"),
        F.slice("all", F.col("begin.at") + 1, F.col("begin.size")).alias("bag"),
    )
    windows = windows.withColumn("print", fingerprint(F.col("bag")))
    cut = lambda rows: rows.withColumn("block", F.explode(blocks(F.col("print"), radius)))
    indexed = cut(items.withColumn("print", fingerprint(F.col("bag")))).select(
        F.col("size"), F.col("block"), "item", F.col("bag").alias("item_bag"), F.col("print").alias("item_print")
    )
    near = cut(windows).join(indexed, ["size", "block"]).filter(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    )
    # A pair may share several blocks: it is verified at the first one only.
    shared = F.array_position(
        F.zip_with(blocks(F.col("print"), radius), blocks(F.col("item_print"), radius), lambda a, b: a["value"] == b["value"]), True
    )
    near = near.filter(F.col("block.number") == shared - 1)
    verified = near.withColumn("similarity", similarity(F.col("bag"), F.col("item_bag"))).filter(F.col("similarity") >= least)
    best = F.max(F.struct("similarity", (-F.col("window")).alias("window"))).alias("best")
    return verified.groupBy("key", "item").agg(best).select(
        F.col("key").alias(key), F.col("item").alias(item),
        (-F.col("best.window")).alias("window"), F.round("best.similarity", 6).alias("similarity"),
    )


def clean(df: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose key is in no row of ``found``; null keys are compared like any other."""
    hit = found.select(F.col(f"`{key}`").alias("__hit")).distinct()
    return df.join(hit, F.col(f"`{key}`").eqNullSafe(F.col("__hit")), "left_anti")


def _sql_shingles(table: str, key: str) -> str:
    return f"""
  SELECT {key}, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i : array_to_string(w[i:i + {WORDS - 1}], ' ')) END AS s
  FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x : x <> '') AS w
        FROM {table})"""


ORACLE = f"""
WITH docs AS ({_sql_shingles("documents", "doc_id")}
), items AS ({_sql_shingles("benchmark", "item_id")}
), item_counts AS (
  SELECT item_id, len(s) AS size, g, count(*) AS n FROM (SELECT item_id, s, unnest(s) AS g FROM items) GROUP BY ALL
), placed AS (
  SELECT doc_id, len(s) AS total, unnest(s) AS g, generate_subscripts(s, 1) - 1 AS pos FROM docs
), begins AS (
  SELECT DISTINCT doc_id, least(pos, greatest(total - size, 0)) AS pos, size FROM placed JOIN (SELECT DISTINCT size, g FROM item_counts) USING (g)
), windows AS (
  SELECT doc_id, b.pos, size, s[b.pos + 1:b.pos + size] AS bag FROM begins b JOIN docs USING (doc_id)
), window_counts AS (
  SELECT doc_id, pos, size, held, g, count(*) AS n
  FROM (SELECT doc_id, pos, size, len(bag) AS held, unnest(bag) AS g FROM windows) GROUP BY ALL
), shared AS (
  SELECT doc_id, item_id, w.pos, held, size, sum(least(w.n, i.n)) AS k
  FROM window_counts w JOIN item_counts i USING (size, g) GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, pos, k / (held + size - k) AS similarity FROM shared WHERE k / (held + size - k) >= {SIMILARITY}
)
SELECT doc_id, item_id, arg_min(pos, (-similarity, pos))::INTEGER AS "window", round(max(similarity), 6) AS similarity
FROM scored GROUP BY doc_id, item_id
"""
