"""Helpers shared by the operators: columns, shared tables, and vectorised words over Arrow batches.

The Arrow helpers work on one slice of a batch at a time (about ``CHUNK_BYTES`` of text, one document at
least), so memory in a task follows the longest document and not the partition.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.sources.scratch import shared_folder

CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def remainder(name: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def stored_in(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``stored``, and the folder, for tables that can be removed once their successor is written."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage at a copy that outlives executors."""
    return stored_in(df, purpose)[0]


# ---------------------------------------------------------------- text in Arrow batches

Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory to the system. Workers are reused: an idle one would hold its last task's peak."""
    _powers.update(_NO_POWERS)
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, after which the task gives its memory back."""

    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()

    return wrapped


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of text each."""
    _, offsets = buffer_of(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, min(last, batch.num_rows))
        yield batch.slice(first, last - first)
        first = last


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and where each begins (with the end of the last)."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, dtype=np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.default_rng(20_011)
_BYTE_CODES = _RANDOM.integers(0, 2**64, size=256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_NO_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_powers: dict[str, np.ndarray] = dict(_NO_POWERS)  # grows with the longest slice of a task


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = n + n // 4
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all positions (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span; equal spans get equal hashes wherever they stand."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts: start, end (exclusive) and index of the text."""
    if len(data) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    inside = ~SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    per_text = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(per_text)), per_text)


_PLACES = _RANDOM.integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def windows(values: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` values of one owner, and where each run begins in ``values``."""
    if len(values) < size:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    n = len(values) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for place in range(size):
        total += values[place : place + n] * _PLACES[place]
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mixed(total[at]), at
