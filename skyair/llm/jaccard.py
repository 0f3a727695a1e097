"""Similarity join of texts by the Jaccard similarity of their five-word shingles, by chosen paths.

1. Texts with the same set of shingles form a class; its smallest id stands for it from here on.
2. Each set is embedded as ``TOKENS`` minima of random functions: two sets agree at a place with a
   probability equal to their similarity.
3. Chosen paths: from the root of a run, a set goes into the bucket of every token that a hash of the path
   and the token samples, with probability 1 / (similarity * TOKENS). Buckets of more than ``BUCKET`` sets are
   split again by further tokens, up to ``DEPTH`` times. Two sets at the threshold then meet in a leaf of one run
   with a probability known from the branching process, and runs are repeated until the target recall. Sets that
   are close to a large bucket's reference are linked to it and need not be split further.
4. Small leaves are compared by brute force on the embedded sets, with a margin of five deviations; the
   sets in what remains large at the last level are all taken together. This gives groups that hold every
   link found.
5. Each group is compared exactly, all pairs. A large group is cut into blocks of ``BLOCK`` sets and every
   pair of blocks is a piece of work of its own, so no task holds a whole group.

Only one row per set and piece leaves a task: the number of its links and one link into its part. No list of
pairs is ever written, and links between any two different sets of a group are counted exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import buffer_of, chunks, lean, mixed, span_hashes, stored, windows, word_spans
from skyair.llm.components import components

WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.99
TOKENS = 128
DEPTH = 6
BUCKET = 256
BLOCK = 512
#: Bytes of text whose shingles are made at a time; their arrays take up to fifty times as much.
SLICE_BYTES = 1 << 18
#: Size of the filter that keeps texts outside all groups from the shuffle, whatever the input.
FILTER_BITS = 1 << 26

_DRAWN = np.random.default_rng(91)
_FACTORS = _DRAWN.integers(0, 2**63, size=TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAWN.integers(0, 2**63, size=TOKENS, dtype=np.uint64)


def runs_for(recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold met with probability ``recall``, if split ``depth`` times.

    Each level keeps one shared bucket on average; a pair is lost once it keeps none. In how many of the
    TOKENS places two sets agree is fixed for all runs and binomial, so the chance is averaged over it.
    """

    def meets(agree: int) -> float:
        kept = 1.0
        for _ in range(depth):
            kept = 1 - exp(-kept * agree / TOKENS / SIMILARITY)
        return kept

    share = [comb(TOKENS, k) * SIMILARITY**k * (1 - SIMILARITY) ** (TOKENS - k) for k in range(TOKENS + 1)]
    missed = [1 - meets(k) for k in range(TOKENS + 1)]
    runs = 1
    while sum(p * m**runs for p, m in zip(share, missed)) > 1 - recall:
        runs += 1
    return runs


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of every text in ascending order, and the text each belongs to.

    A text of fewer than WORDS words has one shingle, all its words; a text without words has none.
    """
    data, offsets = buffer_of(texts)
    starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    found, at = windows(words, owner, WORDS)
    found, whose = [found], [owner[at]]
    length = np.bincount(owner, minlength=len(texts))
    for size in range(1, WORDS):
        own = length[owner] == size
        few, at = windows(words[own], owner[own], size)
        found.append(mixed(few + np.uint64(size)))
        whose.append(owner[own][at])
    found, whose = np.concatenate(found), np.concatenate(whose)
    order = np.lexsort((found, whose))
    found, whose = found[order], whose[order]
    if len(found):
        new = np.concatenate([[True], (found[1:] != found[:-1]) | (whose[1:] != whose[:-1])])
        found, whose = found[new], whose[new]
    return found, whose


def _signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, 128-bit digest of its set of shingles, number of shingles, and the embedded set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                n = part.num_rows
                found, whose = shingle_sets(part.column("text"))
                count = np.bincount(whose, minlength=n)
                filled = np.flatnonzero(count)
                first = np.searchsorted(whose, filled)
                digests = np.zeros((2, n), dtype=np.uint64)
                tokens = np.zeros((n, TOKENS), dtype=np.uint32)
                if len(filled):
                    digests[0, filled] = np.add.reduceat(mixed(found), first)
                    digests[1, filled] = np.add.reduceat(mixed(found ^ _SHIFTS[0]), first)
                    for k in range(TOKENS):
                        values = ((found * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
                        tokens[filled, k] = np.minimum.reduceat(values, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"), pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)),
                        pa.array(count.astype(np.int64)), pa.array([t.tobytes() for t in tokens], pa.binary()),
                    ],
                    names=["key", "k1", "k2", "n", "tokens"],
                )

    fed = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return fed.mapInArrow(lean(run), "key bigint, k1 bigint, k2 bigint, n bigint, tokens binary")


def _matrix(tokens: pa.Array) -> np.ndarray:
    """Embedded sets as rows."""
    return np.frombuffer(b"".join(tokens.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


def _sampled(tokens: np.ndarray, paths: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows and paths that follow: every token of a row that the hash of its path and the token samples."""
    places = np.arange(1, TOKENS + 1, dtype=np.uint64) << np.uint64(32)
    drawn = mixed(mixed(paths)[:, None] ^ mixed(places | tokens))
    rows, place = np.nonzero(drawn < np.uint64(int(2**64 / (similarity * TOKENS))))
    return rows, mixed(drawn[rows, place] + np.uint64(1)).view(np.int64)


def _first_level(sets: DataFrame, runs: int, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                tokens, nodes = _matrix(part.column("tokens")), part.column("node")
                for r in range(runs):
                    root = np.full(len(tokens), 1 + r, dtype=np.uint64)
                    rows, paths = _sampled(tokens, root, similarity)
                    yield pa.RecordBatch.from_arrays([pa.array(paths), nodes.take(pa.array(rows))], names=["path", "node"])

    return sets.select("node", "tokens").mapInArrow(lean(run), "path bigint, node bigint")


def _next_level(large: DataFrame, similarity: float) -> DataFrame:
    """Rows (path, node, tokens, to): the next paths of the sets of large buckets, and links (node, to).

    Each bucket has a reference, its smallest set. Sets near it, at half the distance of the threshold more
    than that, are linked to it and split no further, so near copies do not multiply. What may be similar to one
    of them is, by the triangle inequality of the distance, within the sum of both distances of the reference
    and linked to it too, but goes on.
    """
    margin = 5 * (0.25 / TOKENS) ** 0.5
    near = 1 - 1.5 * (1 - similarity)
    reach = near - (1 - similarity) - margin
    # Stored, as are the other tables of one row per path: next to a plain scan a hot path can be split.
    references = large.groupBy("path").agg(F.min_by("tokens", "node").alias("own"), F.min("node").alias("to"))
    references = stored(references, "references")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                tokens = _matrix(part.column("tokens"))
                alike = (tokens == _matrix(part.column("own"))).mean(axis=1)
                linked = np.flatnonzero((alike >= reach) & (part.column("node").to_numpy() != part.column("to").to_numpy()))
                links = part.take(pa.array(linked))
                yield pa.RecordBatch.from_arrays(
                    [links.column("path"), links.column("node"), pa.nulls(len(linked), pa.binary()), links.column("to")],
                    names=["path", "node", "tokens", "to"],
                )
                part = part.take(pa.array(np.flatnonzero(alike < near)))
                before = part.column("path").to_numpy().view(np.uint64)
                rows, paths = _sampled(_matrix(part.column("tokens")), before, similarity)
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths), taken.column("node"), taken.column("tokens"), pa.nulls(len(rows), pa.int64())],
                    names=["path", "node", "tokens", "to"],
                )

    rows = large.select("path", "node", "tokens").join(references, "path")
    return rows.select("path", "node", "tokens", "own", "to").mapInArrow(lean(run), "path bigint, node bigint, tokens binary, to bigint")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted rows."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for values in columns:
            new[1:] |= values[1:] != values[:-1]
        new[0] = bool(rest) and any(rest[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        edges = [0, *np.flatnonzero(new[1:]) + 1, batch.num_rows]
        if new[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        for low, high in zip(edges, edges[1:]):
            rest.append(batch.slice(low, high - low))
            if high < batch.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each, in a symmetric matrix of links."""
    root = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(linked, root[None, :], len(linked)).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _leaf_links(leaves: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that connect the likely similar sets of every small leaf."""
    margin = 5 * (similarity * (1 - similarity) / TOKENS) ** 0.5
    of_leaf = leaves.groupBy("path").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"),
        F.min("node").alias("low"), F.max("node").alias("high"),
    )
    # Runs meet again in leaves with the same members: one of them is enough.
    paths = of_leaf.groupBy("size", "sum", "low", "high").agg(F.min("path").alias("path")).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["path"]):
            nodes = group.column("node").to_numpy()
            tokens = _matrix(group.column("tokens").combine_chunks())
            alike = np.stack([(tokens == row).mean(axis=1) for row in tokens])
            root = _roots(alike >= similarity - margin)
            other = np.flatnonzero(root != np.arange(len(root)))
            if len(other):
                yield pa.RecordBatch.from_pydict({"a": nodes[other], "b": nodes[root[other]]})

    rows = leaves.join(paths, "path").join(sets.select("node", "tokens"), "node")
    return rows.repartition("path").sortWithinPartitions("path").select("path", "node", "tokens").mapInArrow(lean(run), "a bigint, b bigint")


def _candidates(sets: DataFrame, runs: int, similarity: float) -> DataFrame:
    """Edges (a, b) that connect all sets that may be similar."""
    level = stored(_first_level(sets, runs, similarity), "paths")
    small, edges = [], []
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size"))
        sizes = stored(sizes.filter(F.col("size") > 1), "path-sizes")
        sized = stored(level.join(sizes, "path"), "paths")
        small.append(sized.filter(F.col("size") <= BUCKET).select("path", "node"))
        large = sized.filter(F.col("size") > BUCKET)
        if large.isEmpty():
            break
        if depth == DEPTH:
            low = stored(large.groupBy("path").agg(F.min("node").alias("b")), "path-roots")
            edges.append(large.join(low, "path").select(F.col("node").alias("a"), "b"))
            break
        if depth == 1:
            large = large.select("path", "node").join(sets.select("node", "tokens"), "node")
        went = stored(_next_level(large, similarity), "paths")
        edges.append(went.filter(F.col("to").isNotNull()).select(F.col("node").alias("a"), F.col("to").alias("b")))
        level = went.filter(F.col("to").isNull()).select("path", "node", "tokens")
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.unionByName(more)
    edges.append(_leaf_links(leaves, sets, similarity))
    found = edges[0]
    for more in edges[1:]:
        found = found.unionByName(more)
    return found


def _bit_of(nodes: np.ndarray) -> np.ndarray:
    return (mixed(nodes.astype(np.int64).view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _bits_of(groups: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS bits, 8 MB at most: a node of a group has its bit set, and few others have."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _bit_of(batch.column("node").to_numpy())
            one = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"word": bit >> 6, "bits": one})

    found = groups.select("node").mapInArrow(lean(words), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = found.toArrow()
    table = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    table[np.asarray(found.column("word"), dtype=np.int64)] = np.asarray(found.column("bits"), dtype=np.int64).view(np.uint64)
    return table


def _exact(df: DataFrame, groups: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """Rows (node, links, root): per piece of work, a set's links and the smallest set of its part."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = stored(sizes, "component-sizes")
    placed = groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    wanted = df.sparkSession.sparkContext.broadcast(_bits_of(groups))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            batch = batch.filter(batch.column("node").is_valid())
            nodes = _bit_of(batch.column("node").to_numpy())
            batch = batch.take(pa.array(np.flatnonzero(bits[nodes >> 6] >> (nodes & 63).astype(np.uint64) & np.uint64(1))))
            for part in chunks(batch, limit=SLICE_BYTES):
                found, whose = shingle_sets(part.column("text"))
                edges = np.searchsorted(whose, np.arange(part.num_rows + 1))
                coded = [found[a:b].tobytes() for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(coded, pa.binary())], names=["node", "found"])

    docs = df.select(F.col(f"`{key}`").cast("bigint").alias("node"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # Texts outside all groups are left out before the shuffle; what the filter lets through wrongly, the join drops.
    held = docs.mapInArrow(lean(sets), "node bigint, found binary").join(placed, "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pieces = held.select("node", "component", "block", "found", other).select(
        "component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "block", "found"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["component", "one", "two"]):
            order = np.argsort(group.column("node").to_numpy(), kind="stable")
            group = group.take(pa.array(order))
            nodes, block = group.column("node").to_numpy(), group.column("block").to_numpy()
            coded = [np.frombuffer(v, dtype=np.uint64) for v in group.column("found").to_pylist()]
            size = np.array([len(v) for v in coded])
            both = _shared(coded)
            linked = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
            linked &= nodes[:, None] != nodes[None, :]
            if group.column("one")[0] != group.column("two")[0]:
                linked &= block[:, None] != block[None, :]
            root = _roots(linked)
            yield pa.RecordBatch.from_pydict({"node": nodes, "links": linked.sum(axis=1), "root": nodes[root]})

    keys = ["component", "one", "two"]
    return pieces.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(compare), "node bigint, links bigint, root bigint")


def _shared(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each two sets share."""
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    common = times > 1
    place = (np.cumsum(common) - 1)[column]
    keep = common[column]
    row, place = row[keep], place[keep]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    total = int(common.sum())
    for low in range(0, total, width):
        a, b = np.searchsorted(place, [low, low + width])
        part = np.zeros((len(sets), min(width, total - low)), dtype=np.float32)
        part[row[a:b], place[a:b] - low] = 1
        both += part @ part.T
    return both


def join(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = TARGET_RECALL
) -> DataFrame:
    """One row per row of ``df``: key, ``class_id``, ``copy_of`` and ``n_links``.

    ``copy_of`` is the smallest id with the same set of shingles, ``class_id`` the smallest id that chains of
    links lead to, ``n_links`` the number of other sets of shingles with a similarity of ``similarity`` or
    more. Ids are whole numbers; rows that share an id are taken as one document. Null, empty and
    wordless texts have no links and are their own class. A row with a null id takes the class of its
    copies, if they have an id. Other columns are ignored.
    """
    signed = stored(_signatures(df, key, text), "signatures")
    worded = signed.filter(F.col("n") > 0)
    classes = stored(
        worded.filter(F.col("key").isNotNull()).groupBy("k1", "k2").agg(F.min("key").alias("node")), "classes"
    )
    sets = worded.join(classes, ["k1", "k2"]).filter(F.col("key") == F.col("node")).select("node", "tokens")
    # Of different texts that share an id the smallest signature stands for it, whatever the partitioning.
    sets = sets.groupBy("node").agg(F.min("tokens").alias("tokens"))
    sets = stored(sets, "sets")
    groups = components(_candidates(sets, runs_for(recall), similarity))
    compared = stored(_exact(df, groups, key, text, similarity), "compared")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = (
        classes.join(links, "node", "left")
        .join(parts.withColumnRenamed("node", "__member"), F.col("node") == F.col("__member"), "left")
        .select("k1", "k2", "node", "links", "component")
    )
    return (
        signed.select("key", "k1", "k2", "n")
        .join(found, ["k1", "k2"], "left")
        .select(
            F.col("key").alias(key),
            F.coalesce("component", "node", "key").alias("class_id"),
            F.coalesce("node", "key").alias("copy_of"),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        )
    )


def keep_one(df: DataFrame, joined: DataFrame, key: str = "doc_id") -> DataFrame:
    """``df`` without the documents that are not the first of their class; rows with a null id stay."""
    dropped = joined.filter(F.col(key) != F.col("class_id")).select(F.col(key).alias("__dropped")).distinct()
    return df.join(dropped, F.col(f"`{key}`").cast("bigint") == F.col("__dropped"), "left_anti")


ORACLE = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x : x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i : array_to_string(w[i:i + {WORDS - 1}], ' ')))) END AS s
  FROM words
), classes AS (
  SELECT s, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS (
  SELECT node, len(s) AS n, unnest(s) AS g FROM classes
), links AS (
  SELECT a.node AS a, b.node AS b, count(*) AS k, max(a.n) AS an, max(b.n) AS bn
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.node <> b.node GROUP BY a.node, b.node
  HAVING count(*) >= {SIMILARITY} * (max(a.n) + max(b.n) - count(*)) - 1e-9
), reached AS (
  SELECT node AS a, node AS b FROM classes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (
  SELECT a AS node, min(b) AS root FROM reached GROUP BY a
), counted AS (
  SELECT a AS node, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(root, doc_id) AS class_id, coalesce(c.node, doc_id) AS copy_of, coalesce(n_links, 0) AS n_links
FROM sets LEFT JOIN classes c USING (s) LEFT JOIN roots r ON c.node = r.node LEFT JOIN counted n ON c.node = n.node
"""
