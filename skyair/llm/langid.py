"""Language identification with hyperdimensional profiles.

Every letter, of any script, has a random vector of +1 and -1, drawn from its code point by a seeded hash. A
letter's place in an n-gram is bound in by rotating its vector, the rotated vectors of an n-gram are
multiplied, and the vectors of all n-grams of a text are added up. A language's prototype is the sum over
its training texts; a text gets the language whose prototype has the largest cosine with it.

Prototypes are sums of per-task sums, so they cover every training text, whatever the number of tasks.
What reaches the driver and the tasks is one vector per language, for ``MOST_LANGUAGES`` languages at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import buffer_of, chunks, lean, mixed

DIMENSIONS = 1024
SEED = 7
UNKNOWN = "und"
#: Labels that are learned: at most this many, those of most rows (then by name). A column of languages has
#: fewer; one that holds anything else must not fill the driver.
MOST_LANGUAGES = 512
#: A text in no known language has a cosine of about 0 with every prototype, give or take 1 / sqrt(DIMENSIONS).
#: Below this many times that it is like none of them ...
NOISE_DEVIATIONS = 3.0
#: ... if it has so many n-grams at least: in a short text of a language a few rare ones may be all there is.
NOISE_LETTERS = 24

_PLACE = 1 << 21  # letters of a gram are digits of this base; 0 is the gap between words
_BLOCK = 1024  # gram vectors that are held at a time
_ROWS = 128  # texts that are added up at a time


@lru_cache(maxsize=1)
def _letter_of_codepoint() -> np.ndarray:
    """The lower-case letter of every code point, 0 for what is no letter."""
    table = np.zeros(0x110000, dtype=np.int32)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = ord(chr(point).lower()[0])
    return table


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """The vector of every code point: the bits of hashes of seed, point and place. The gap has one too."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    seeds = mixed(letters.astype(np.uint64) + np.uint64(SEED << 32))
    bits = mixed(seeds[:, None] + words * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vector of every three-letter code."""
    digits = np.stack([grams // _PLACE**2, grams // _PLACE % _PLACE, grams % _PLACE])
    letters, place = np.unique(digits, return_inverse=True)
    vectors = letter_vectors(letters)
    first, second, third = place.reshape(digits.shape)
    return np.roll(vectors, 2, axis=1)[first] * np.roll(vectors, 1, axis=1)[second] * vectors[third]


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Three-letter codes of all texts and the text each belongs to; a gap only ever in one row."""
    data, offsets = buffer_of(texts)
    points = np.frombuffer(bytes(data).decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    begins = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    begins = begins[offsets]  # of each text, in code points
    letters = _letter_of_codepoint()[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(begins))
    kept = np.ones(len(letters), dtype=bool)
    if len(letters) > 1:
        kept[1:] = (letters[1:] > 0) | (letters[:-1] > 0) | (owner[1:] != owner[:-1])
    letters, owner = letters[kept], owner[kept]
    # A gap before and after every text, so that even a single letter has an n-gram.
    counts = np.bincount(owner, minlength=len(texts))
    places = np.arange(len(letters)) + 2 * owner + 1
    padded = np.zeros(len(letters) + 2 * len(texts), dtype=np.int64)
    padded[places] = letters
    padded_owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts + 2)
    if len(padded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    codes = (padded[:-2] * _PLACE + padded[1:-1]) * _PLACE + padded[2:]
    whole = (padded_owner[:-2] == padded_owner[2:]) & (padded[1:-1] > 0)  # centred on a letter
    return codes[whole], padded_owner[:-2][whole]


def _bundled(grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the gram vectors of each of ``n`` owners; a block of gram vectors exists at a time."""
    total = np.zeros((n, DIMENSIONS))
    listed, place = np.unique(grams, return_inverse=True)
    order = np.argsort(place // _BLOCK, kind="stable")
    edges = np.searchsorted(place[order] // _BLOCK, np.arange(-(-len(listed) // _BLOCK) + 1))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        some = listed[k * _BLOCK : (k + 1) * _BLOCK]
        cells = owner[order[a:b]].astype(np.int64) * len(some) + place[order[a:b]] - k * _BLOCK
        counts = np.bincount(cells, minlength=n * len(some)).reshape(n, -1)
        # Whole numbers below 2^24 in a text or slice, so single precision is exact.
        total += counts.astype(np.float32) @ gram_vectors(some).astype(np.float32)
    return total


def languages(df: DataFrame, label: str = "lang", most: int = MOST_LANGUAGES) -> list[str]:
    """The labels to learn: those of most rows, at most ``most`` of them."""
    named = df.select(F.col(f"`{label}`").alias("label")).filter(F.col("label").isNotNull())
    counts = named.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r["label"] for r in counts.orderBy(F.desc("n"), "label").limit(most).collect())


def train(df: DataFrame, label: str = "lang", text: str = "text", most: int = MOST_LANGUAGES) -> dict[str, np.ndarray]:
    """Prototype of every language in ``label``, from all rows whose label is not null."""
    names = languages(df, label, most)
    number = {name: k for k, name in enumerate(names)}

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(names), DIMENSIONS))
        for batch in batches:
            for part in chunks(batch, limit=1 << 17):
                grams, owner = _grams(part.column("text"))
                labels = np.array([number[x] for x in part.column("label").to_pylist()])
                used, own = np.unique(labels[owner], return_inverse=True)
                totals[used] += _bundled(grams, own, len(used))
        for k in np.flatnonzero(totals.any(axis=1)):
            rows = {"label": [names[k]] * DIMENSIONS, "place": np.arange(DIMENSIONS, dtype=np.int32), "value": totals[k].astype(np.int64)}
            yield pa.RecordBatch.from_pydict(rows)

    rows = (
        df.select(F.col(f"`{label}`").alias("label"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .filter(F.col("label").isin(names))
        .mapInArrow(lean(bundle), "label string, place int, value bigint")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
    )
    prototypes = {name: np.zeros(DIMENSIONS) for name in names}
    for name, place, value in rows.collect():  # languages x DIMENSIONS numbers
        prototypes[name][place] = value
    return prototypes


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` without its text (unless ``keep_text``), plus ``lang_pred``, ``score`` and ``n_letters``.

    ``score`` is the cosine, 0 where it is negative; ``n_letters`` the number of letters, and so of
    n-grams. Null, empty and letterless texts, and every text where there is no prototype, give ``und`` with
    score 0. Ties go to the first language in order of name. Repeated rows are repeated in the result.
    Columns of ``df`` named like the results are replaced.
    """
    names = sorted(prototypes)
    table = np.zeros((len(names), DIMENSIONS))
    for k, name in enumerate(names):
        length = np.linalg.norm(prototypes[name])
        table[k] = prototypes[name] / length if length else 0

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in chunks(batch, "__text", 1 << 19):
                for k in range(0, whole.num_rows, _ROWS):
                    part = whole.slice(k, _ROWS)
                    n = part.num_rows
                    grams, owner = _grams(part.column("__text"))
                    letters = np.bincount(owner, minlength=n)
                    best, score = np.zeros(n, dtype=np.int64), np.zeros(n)
                    if len(names):
                        texts = _bundled(grams, owner, n)
                        cosines = texts @ table.T / np.maximum(np.linalg.norm(texts, axis=1), 1e-9)[:, None]
                        best, score = np.argmax(np.round(cosines, 6), axis=1), np.clip(cosines.max(axis=1), 0, 1)
                    lettered = letters > 0 if len(names) else np.zeros(n, dtype=bool)
                    found = [names[b] if x else UNKNOWN for b, x in zip(best, lettered)]
                    results = [pa.array(found, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(letters)]
                    columns = [part.column("__text" if c == source else c) for c in kept]
                    yield pa.RecordBatch.from_arrays([*columns, *results], names=[*kept, *_RESULTS])

    # The text goes to the task once, also where it comes back.
    source = text if keep_text else None
    kept = [c for c in df.columns if c not in _RESULTS and (keep_text or c not in (text, "text"))]
    fed = df.select(*(F.col(f"`{c}`") for c in kept if c != source), F.col(f"`{text}`").alias("__text"))
    schema = [f"`{c}` {kind}" for c, kind in df.select(*(F.col(f"`{c}`") for c in kept)).dtypes]
    return fed.mapInArrow(lean(label), ", ".join([*schema, *(f"{c} {kind}" for c, kind in _RESULTS.items())]))


_RESULTS = {"lang_pred": "string", "score": "double", "n_letters": "bigint"}


def in_a_language(score: str = "score", letters: str = "n_letters") -> Column:
    """Whether a text is more like a learned language than noise is; short texts get the benefit of the doubt."""
    noise = NOISE_DEVIATIONS / DIMENSIONS**0.5
    return (F.col(letters) > 0) & ((F.col(letters) < NOISE_LETTERS) | (F.col(score) >= noise))
