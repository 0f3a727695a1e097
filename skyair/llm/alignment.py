"""Alignment of the token ids that two tokenizers give the same text.

Every text is tokenised whole by both. Where tokens of both end at the same byte, a group ends. Shared ends
before tokens that are marked with a space on both sides are anchors: they cut a text into windows of about
a word, and what happens inside a window depends on its two tuples of ids alone. So the alignment of a
window (its groups, and its links: pairs of tokens whose bytes overlap) is worked out once and looked up
by the ids from then on; the memo is bounded and emptied when it is full.

Counts of linked id pairs go over the whole corpus, as a Spark table. The most frequent pairs, a bounded
number, travel to the tasks that rate the links; every other pair is joined to its count through a shuffle.

The tokenizers are files of fixed size that the driver reads.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import chunks, lean, stored

BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs sent to every task: at most this many, the most frequent; 17 bytes each.
FREQUENT_PAIRS = 1 << 19
#: Bytes of windows a task remembers, and the longest window (tokens of one side) that is looked up again.
MEMO_BYTES, MEMO_TOKENS = 64 << 20, 32

#: Fixed value: how the byte-level vocabulary cuts a text before merging.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with a longer word or gap go to the library that is not quadratic in it.
_LONG = 2000
_LONG_GAP = re.compile(rf"\s{{{_LONG}}}")
_SIGN = "▁"


def _has_long_stretch(text: str) -> bool:
    return len(text) > _LONG and (max(map(len, text.split()), default=0) > _LONG or bool(_LONG_GAP.search(text)))


def _byte_of_sign() -> dict[str, int]:
    """The byte that each printable sign of a byte-level vocabulary stands for."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a byte-level vocabulary without special tokens, and the bytes of every id."""

    def __init__(self, file: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(file)
        self.slow.encode_special_tokens = True
        described = json.loads(file)
        signs = _byte_of_sign()
        added = {t["id"] for t in described["added_tokens"]}
        vocabulary = described["model"]["vocab"]
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = token.encode() if i in added else bytes(signs[c] for c in token)
        # Merges in order of id: then ids are ranks, and the faster library gives the same ids.
        merges = [m if isinstance(m, str) else " ".join(m) for m in described["model"]["merges"]]
        ranked = all(vocabulary.get(m.replace(" ", "")) == 256 + k for k, m in enumerate(merges))
        plain = described["normalizer"] is None and described["pre_tokenizer"]["type"] == "ByteLevel"
        self.fast = None
        if ranked and plain and not described["pre_tokenizer"]["add_prefix_space"]:
            ranks = {value: i for i, value in enumerate(self.bytes_of) if i not in added}
            self.fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or _has_long_stretch(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokenizer:
    """Ids of a piece vocabulary, which puts a space before a text, and the bytes of every id."""

    def __init__(self, file: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_SIGN, " ").encode()
            for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Side(NamedTuple):
    """One tokenizer as arrays by id: bytes of a token, and whether it begins with a space."""

    length: np.ndarray
    spaced: np.ndarray

    @staticmethod
    def of(bytes_of: list[bytes]) -> Side:
        return Side(np.array([len(v) for v in bytes_of], dtype=np.int64), np.array([v[:1] == b" " for v in bytes_of]))


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for every count, one after another."""
    return np.arange(counts.sum()) - np.repeat(_starts(counts), counts)


class Memo:
    """What is inside a window, by its two tuples of ids: text of its groups, and its linked pairs.

    Both tuples make one key: the ids of the first side, then those of the second, numbered on from there.
    """

    def __init__(self, a: Side, b: Side, most: int = MEMO_BYTES) -> None:
        self.a, self.b, self.most = a, b, most
        # How an id is written: before another of its group, at the end of it, at the end of its window.
        self.written = [f"{i}{end}" for i in range(len(a.length)) for end in ",|"]
        self.written += [f"{i}{end}" for i in range(len(b.length)) for end in ",;\n"]
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.links: list[bytes] = []  # per window: 64 bits a pair, the first id in the upper half
        self.held = 0

    def of(self, windows: list[bytes]) -> list[int]:
        """Numbers of windows, whose ids are 32-bit values; those that are new are aligned."""
        known = self.place.get
        found = [known(window, -1) for window in windows]
        new = dict.fromkeys([window for window, number in zip(windows, found) if number < 0])
        if new:
            for number, window in enumerate(new, len(self.groups)):
                new[window] = number
                if len(window) <= 8 * MEMO_TOKENS:
                    self.place[window] = number
            ids = np.frombuffer(b"".join(new), dtype=np.int32)
            first = ids < len(self.a.length)
            sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new)) // 4
            n_a = np.add.reduceat(first, _starts(sizes), dtype=np.int64)
            groups, links = self.aligned(ids[first], ids[~first] - len(self.a.length), n_a, sizes - n_a)
            self.groups += groups
            self.links += links
            self.held += sum(map(len, groups)) + sum(map(len, links)) + 4 * len(ids) + 300 * len(new)
            found = [new[window] if number < 0 else number for window, number in zip(windows, found)]
        return found

    def aligned(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[list[str], list[bytes]]:
        """Groups and linked pairs of windows that stand one after another on both sides."""
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        marks = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
        marks[ends_a] |= 1
        marks[ends_b] |= 2
        last_a, last_b = (marks[ends] == 3 for ends in (ends_a, ends_b))  # of their group
        ending = last_b.astype(np.int64)
        ending[np.cumsum(n_b) - 1] = 2
        codes = np.concatenate([2 * a + last_a, 2 * len(self.a.length) + 3 * b + ending])
        groups = np.concatenate([2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1])
        written = self.written
        text = "".join([written[c] for c in codes[np.argsort(groups, kind="stable")].tolist()])
        # A token meets those of the other side from the one its first byte is in to that of its last.
        first = np.searchsorted(ends_b, ends_a - self.a.length[a], side="right")
        times = np.searchsorted(ends_b, ends_a, side="left") - first + 1
        pairs = (np.repeat(a.astype(np.int64), times) << 32 | b[_within(times) + np.repeat(first, times)]).tobytes()
        edges = [0, *(8 * np.cumsum(np.add.reduceat(times, _starts(n_a)))).tolist()]
        return text.split("\n")[:-1], [pairs[p:q] for p, q in zip(edges[:-1], edges[1:])]

    def full(self) -> bool:
        return self.held > self.most


class Tokenizers(NamedTuple):
    """The two files as they stand; what travels to the tasks."""

    byte_file: str
    piece_file: bytes


def load_tokenizers(byte_path: str = BYTE_TOKENIZER, piece_path: str = PIECE_TOKENIZER) -> Tokenizers:
    with open(byte_path, encoding="utf-8") as one, open(piece_path, "rb") as two:
        return Tokenizers(one.read(), two.read())


class Aligner:
    """Tokenises and aligns texts, many at a time."""

    def __init__(self, files: Tokenizers, memo_bytes: int = MEMO_BYTES) -> None:
        self.a, self.b = ByteTokenizer(files.byte_file), PieceTokenizer(files.piece_file)
        self.memo = Memo(Side.of(self.a.bytes_of), Side.of(self.b.bytes_of), memo_bytes)

    def ids(self, text: str | None) -> tuple[list[int], list[int]]:
        """Both id lists; empty ones unless both spell a space and the text."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        exact = all(b"".join(map(t.bytes_of.__getitem__, ids)) == whole for t, ids in ((self.a, a), (self.b, b)))
        return (a, b) if exact else ([], [])

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
        """Tokens per text on either side, the memo's number of every window, and windows per text."""
        pairs = [self.ids(text) for text in texts]
        n_a, n_b = (np.array([len(p[k]) for p in pairs], dtype=np.int64) for k in (0, 1))
        ids = (chain.from_iterable(p[k] for p in pairs) for k in (0, 1))
        a, b = (np.fromiter(side, dtype=np.int32, count=n.sum()) for side, n in zip(ids, (n_a, n_b)))
        if not len(a):
            return n_a, n_b, [], np.zeros(len(texts), np.int64)
        # Both sides spell the same bytes, so positions are the same on both.
        side_a, side_b = self.memo.a, self.memo.b
        ends_a, ends_b = np.cumsum(side_a.length[a]), np.cumsum(side_b.length[b])
        marks = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
        marks[ends_a] |= 1
        marks[ends_b] |= 2
        marks[(ends_a - side_a.length[a])[side_a.spaced[a]]] |= 4
        marks[(ends_b - side_b.length[b])[side_b.spaced[b]]] |= 8
        text_ends = ends_a[np.cumsum(n_a)[n_a > 0] - 1]
        marks[text_ends] = 15
        anchors = np.flatnonzero(marks == 15)
        window_of = np.cumsum(marks == 15) - (marks == 15)  # number of the window that ends at or after a position
        order = np.argsort(np.concatenate([2 * window_of[ends_a], 2 * window_of[ends_b] + 1]), kind="stable")
        both = np.concatenate([a, b + len(side_a.length)])[order].astype(np.int32).tobytes()
        cuts = [0, *(4 * (np.searchsorted(ends_a, anchors, "right") + np.searchsorted(ends_b, anchors, "right"))).tolist()]
        found = self.memo.of([both[p:q] for p, q in zip(cuts[:-1], cuts[1:])])
        per_text = np.zeros(len(texts), dtype=np.int64)
        per_text[n_a > 0] = np.diff(np.searchsorted(anchors, text_ends, side="right"), prepend=0)
        return n_a, n_b, found, per_text

    def rows(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """The result columns of ``align`` for these texts."""
        n_a, n_b, found, per_text = self.windows(texts)
        memo = self.memo
        stops = np.cumsum(per_text).tolist()
        groups = [";".join([memo.groups[w] for w in found[p:q]]) for p, q in zip([0, *stops], stops)]
        used, place = np.unique(np.array(found, dtype=np.int64), return_inverse=True)
        links = [memo.links[w] for w in used.tolist()]
        sizes = np.array([len(v) // 8 for v in links], dtype=np.int64)
        listed, number = np.unique(np.frombuffer(b"".join(links), dtype=np.int64), return_inverse=True)
        times = sizes[place]
        own = number[_within(times) + np.repeat(_starts(sizes)[place], times)]
        owner = np.repeat(np.repeat(np.arange(len(texts)), per_text), times)
        width = max(1, len(listed))
        cells, counts = np.unique(owner * width + own, return_counts=True)
        offsets = np.searchsorted(cells, width * np.arange(len(texts) + 1)).astype(np.int32)
        if memo.full():
            memo.clear()
        return {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b),
            "n_groups": pa.array(np.array([g.count("|") for g in groups], dtype=np.int64)),
            "n_links": pa.array(np.bincount(owner, minlength=len(texts))), "groups": pa.array(groups, pa.string()),
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(listed[cells % width])),
            "times": pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
        }


_RESULTS = {
    "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups": "string",
    "pairs": "array<bigint>", "times": "array<int>",
}


def align(df: DataFrame, files: Tokenizers | None = None, text: str = "text", memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """``df`` without its text, plus tokens, groups and links of every whole text.

    ``n_a``, ``n_b``: tokens on either side. ``groups``: ``a1,a2|b1;a3|b2,b3``, ids in order. ``n_links``:
    token pairs whose bytes overlap; ``pairs`` (first id in the upper 32 bits) and ``times`` list them.
    Special tokens' strings in a text are text. Null and empty texts, and texts that one of the tokenizers
    does not give back exactly, have no tokens: zeros, an empty string and empty lists. Every row stays,
    repeated ones too; an empty table gives no rows. Columns of ``df`` named like the results are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(files or load_tokenizers())
    kept = [c for c in df.columns if c not in (*_RESULTS, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared.value, memo_bytes)
        for batch in batches:
            for part in chunks(batch, "__text", 1 << 19):
                results = aligner.rows(part.column("__text").to_pylist())
                columns = [*(part.column(c) for c in kept), *results.values()]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *results])

    fed = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("__text"))
    schema = [f"`{c}` {kind}" for c, kind in fed.drop("__text").dtypes]
    return fed.mapInArrow(lean(run), ", ".join([*schema, *(f"{c} {kind}" for c, kind in _RESULTS.items())]))


def pair_counts(rows: DataFrame) -> DataFrame:
    """How many links of all texts hold each pair, and whether no pair with its second id has more (``best``)."""
    linked = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    counts = linked.groupBy(F.col("l.pairs").alias("pair")).agg(F.sum("l.times").alias("links"))
    counts = stored(counts, "pair-counts")
    second = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("second")
    most = counts.groupBy(second).agg(F.max("links").alias("most"))  # a row per id of the vocabulary at most
    whole = counts.withColumn("second", second).join(most, "second")
    return stored(whole.select("pair", "links", (F.col("links") == F.col("most")).alias("best")), "pair-best")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the largest ``links``; rows of about equal ``links`` stay together."""
    step = F.floor(F.log2("links") * 8).cast("int")
    lowest, taken = 1_000, 0
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):  # 512 rows at most
        taken += row["count"]
        if taken > most:
            break
        lowest = row["step"]
    return counts.filter(step >= lowest)


def rate(rows: DataFrame, counts: DataFrame, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """``align``'s rows with ``n_best`` and ``count_sum`` in place of ``pairs`` and ``times``.

    ``n_best``: links whose pair is the most frequent, or one of these, of its second id. ``count_sum``: the
    sum over links of their pair's count. ``rows`` has to be stored, as it is read twice. Where
    ``frequent_pairs`` does not hold all pairs, the results are the same.
    """
    listed = most_frequent(counts, frequent_pairs).toArrow()
    pair, links, best = (np.asarray(listed.column(c)) for c in ("pair", "links", "best"))
    order = np.argsort(pair)
    shared = rows.sparkSession.sparkContext.broadcast((pair[order], links[order], best[order]))
    kept = [c for c in rows.columns if c not in ("pairs", "times", "n_best", "count_sum")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links, best = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                n, lists = part.num_rows, part.column("pairs")
                owner = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False))
                own = lists.flatten().to_numpy()
                times = part.column("times").flatten().to_numpy().astype(np.int64)
                place = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
                known = pair[place] == own if len(pair) else np.zeros(len(own), dtype=bool)
                place, t, o = place[known], times[known], owner[known]
                sums = np.zeros((2, n), dtype=np.int64)
                np.add.at(sums[0], o, t * best[place])
                np.add.at(sums[1], o, t * links[place])
                left = np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=n))]).astype(np.int32)
                results = [
                    pa.array(sums[0]), pa.array(sums[1]),
                    pa.ListArray.from_arrays(left, pa.array(own[~known])),
                    pa.ListArray.from_arrays(left, pa.array(times[~known])),
                ]
                names = [*kept, "n_best", "count_sum", "pairs", "times"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *results], names=names)

    schema = [f"`{c}` {kind}" for c, kind in rows.select(*(F.col(f"`{c}`") for c in kept)).dtypes]
    half = "n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    fed = rows.select(*(F.col(f"`{c}`") for c in kept), "pairs", "times")
    rated = fed.mapInArrow(lean(run), ", ".join([*schema, half]))
    # A number per row: kept in the stored table, so that it is the same whenever it is read.
    rated = stored(rated.withColumn("__row", F.monotonically_increasing_id()), "pair-rated")
    rare = rated.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "__row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("t")
    )
    more = rare.join(counts, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"), F.sum(F.col("t") * F.col("links")).alias("more_sum")
    )
    zero = F.lit(0).cast("bigint")
    return rated.join(more, "__row", "left").select(
        *(F.col(f"`{c}`") for c in kept),
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
    )


def digest(df: DataFrame, key: str = "doc_id", text: str = "text", frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """Key, figures and the hash of the groups of every row of ``df``; no tokens, no hash: an empty string."""
    found = align(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text")))
    hashed = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    rows = stored(found.withColumn("groups_sha256", hashed).drop("groups"), "pair-links")
    return rate(rows, pair_counts(rows), frequent_pairs)
