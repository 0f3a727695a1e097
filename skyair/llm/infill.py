"""Fill-in-the-middle transformation.

A text is cut at two units drawn from its id and written as prefix, suffix and middle with a mark before
each, so that a model learns to write the middle last. A text's bytes are divided into blocks of fixed size;
a Fenwick tree over the blocks holds how many units and how many code points start in each. A cut is found
by descending the tree (binary lifting) to its block and counting units inside that block only; the same
descent gives the code points before the cut.

The output alone gives the text back: see ``restored``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import buffer_of, chunks, lean

#: Bytes of a block.
BLOCK = 512
#: Of 100 texts so many stay as they are, and of 100 transformed ones so many begin with the suffix.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
SEED = "1"


class Marks(NamedTuple):
    """What stands before each part; no mark may begin with an end of one."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


MARKS = Marks()

ORACLE = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4
    FROM drawn
), formed AS (
    SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS suffix FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


class BlockTree:
    """Where units start in a text, found through counts per block.

    ``starts`` are the byte positions at which units start, or None where every code point is a unit.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray | None = None, block: int = BLOCK) -> None:
        self.data, self.starts, self.block = data, starts, block
        self.blocks = -(-len(data) // block)
        edges = np.arange(self.blocks) * block
        leads = (data & 0xC0) != 0x80
        points = np.add.reduceat(leads, edges, dtype=np.int64) if self.blocks else np.zeros(0, np.int64)
        units = points if starts is None else np.bincount(starts // block, minlength=self.blocks)
        self.n_units, self.n_points = int(units.sum()), int(points.sum())
        self.units, self.points = self._tree(units), self._tree(points)

    @staticmethod
    def _tree(counts: np.ndarray) -> np.ndarray:
        """Entry i is the sum of the counts of the blocks i - lowbit(i) to i - 1."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        places = np.arange(len(sums))
        return sums - sums[places & (places - 1)]

    def cut(self, rank: int) -> tuple[int, int]:
        """Byte position before unit number ``rank``, or the end, and the code points before it."""
        if rank >= self.n_units:
            return len(self.data), self.n_points
        block = units = points = 0
        step = 1 << max(0, self.blocks.bit_length() - 1)
        while step:
            after = block + step
            if after <= self.blocks and units + self.units[after] <= rank:
                block = after
                units += int(self.units[after])
                points += int(self.points[after])
            step >>= 1
        first = block * self.block
        inside = self.data[first : first + self.block]
        leads = (inside & 0xC0) != 0x80
        if self.starts is None:
            local = int(np.flatnonzero(leads)[rank - units])
        else:
            local = int(self.starts[np.searchsorted(self.starts, first) + rank - units]) - first
        return first + local, points + int(np.count_nonzero(leads[:local]))


def unit_starts(data: np.ndarray, pattern: re.Pattern | None) -> np.ndarray | None:
    """Byte positions at which units start: at every match of the pattern, and at the text's first byte.

    Matches are taken left to right, empty ones aside. Without a pattern every code point is a unit.
    """
    if pattern is None:
        return None
    byte_of = np.flatnonzero((data & 0xC0) != 0x80)
    found = [m.start() for m in pattern.finditer(bytes(data).decode("utf-8")) if m.end() > m.start()]
    starts = byte_of[np.array(found, dtype=np.int64)] if found else np.zeros(0, np.int64)
    return starts if not len(data) or (len(starts) and starts[0] == 0) else np.concatenate([[0], starts])


def draws(key: str, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 that depend on seed and id alone."""
    found = sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(found[k : k + 4]) for k in (0, 4, 8, 12))


def _written(data: np.ndarray, key: str, pattern, marks: Marks, seed: str) -> tuple[int, str, int | None, int | None, str]:
    tree = BlockTree(data, unit_starts(data, pattern))
    text = bytes(data)
    p, s, m = (mark.encode() for mark in marks)
    one, two, three, four = draws(key, seed)
    if not text or any(mark in text for mark in (p, s, m)) or three % 100 >= 100 - PLAIN_SHARE:
        return tree.n_units, "plain", None, None, text.decode("utf-8")
    ranks = sorted((one % (tree.n_units + 1), two % (tree.n_units + 1)))
    (a, before), (b, until) = map(tree.cut, ranks)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if four % 100 < SUFFIX_FIRST_SHARE else "psm"
    parts = (s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle)
    return tree.n_units, form, before, until - before, b"".join(parts).decode("utf-8")


_RESULTS = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}


def transform(
    df: DataFrame, key: str = "doc_id", text: str = "text", pattern: str | None = None, marks: Marks = MARKS, seed: str = SEED
) -> DataFrame:
    """``df`` without its text, plus ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Units are code points, or run from one match of ``pattern`` to the next. Form is ``psm``, ``spm`` (the
    suffix first) or ``plain``: as it stands, which goes for one text in ten, for empty texts and for those
    that hold a mark; plain texts have null lengths. A null text counts as empty, a null id as empty text.
    What is drawn depends on the id alone, so repeated rows give repeated results. An empty table gives no
    rows. Columns of ``df`` named like the results are replaced.
    """
    compiled = re.compile(pattern) if pattern else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "__text"):
                data, offsets = buffer_of(part.column("__text"))
                keys = part.column("__key").to_pylist()
                found = [
                    _written(data[a:b], k or "", compiled, marks, seed) for k, a, b in zip(keys, offsets[:-1], offsets[1:])
                ]
                made = zip(*found) if found else [[]] * len(_RESULTS)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                results = [pa.array(list(v), kind) for v, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *results], names=[*kept, *_RESULTS])

    kept = [c for c in df.columns if c not in (*_RESULTS, text)]
    fed = df.select(
        *(F.col(f"`{c}`") for c in kept), F.col(f"`{key}`").cast("string").alias("__key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"),
    )
    schema = [f"`{c}` {kind}" for c, kind in fed.drop("__key", "__text").dtypes]
    return fed.mapInArrow(lean(run), ", ".join([*schema, *(f"{c} {kind}" for c, kind in _RESULTS.items())]))


def restored(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The text, from output and form alone. Null output or form gives null."""
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
    )


def digest(written: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, figures and form of ``transform``'s rows, with the hashes of the output and of the text restored from it."""
    return written.select(
        key, "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
