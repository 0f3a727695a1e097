"""Quality rules: counts over words and lines, and a line labeller that decides how much of a text is content.

The labeller is a linear-chain conditional random field over the lines of a text, with the labels
boilerplate (0) and content (1). Each line has a fixed set of yes/no features; Viterbi decoding finds the
best label sequence of the whole text. A text is kept if lines labelled content hold at least half its
words, unless the base rules fail it first.

The weights are fitted here: lines of a bounded sample of labelled texts (``SAMPLE_TEXTS``), each line
labelled as its text is. Everything else covers every line of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import buffer_of, chunks, lean, mixed, span_hashes, windows, word_spans

#: Labelled texts used to fit the weights; the first in order of a hash of their id.
SAMPLE_TEXTS = 4_000
#: Share of a text's words that must stand in content lines.
CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SHOUT = np.zeros(256, dtype=bool)
_SHOUT[[ord("!"), ord("?")]] = True

FEATURES = (
    "always", "one_or_two_words", "few_words", "symbols", "many_symbols", "capitals", "mostly_capitals", "digits",
    "shouts", "seen_before", "repeats", "mostly_repeats", "ends_sentence", "long_words", "short_words",
)


def _ranges(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``total`` over byte ranges."""
    sums = np.zeros(len(total) + 1, dtype=np.int64)
    np.cumsum(total, out=sums[1:])
    return sums[ends] - sums[starts]


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of all texts (split at line ends): start, end and index of the text."""
    breaks = np.flatnonzero(data == 0x0A)
    per_text = np.diff(np.searchsorted(breaks, offsets)) + 1
    owner = np.repeat(np.arange(len(per_text)), per_text)
    first = np.concatenate([[0], np.cumsum(per_text)])
    starts, ends = np.zeros(len(owner), dtype=np.int64), np.zeros(len(owner), dtype=np.int64)
    inner = np.ones(len(owner), dtype=bool)
    inner[first[:-1]] = False
    starts[first[:-1]] = offsets[:-1]
    starts[inner] = breaks + 1
    inner = np.ones(len(owner), dtype=bool)
    inner[first[1:] - 1] = False
    ends[first[1:] - 1] = offsets[1:]
    ends[inner] = breaks
    return starts, ends, owner


def _again(keys: np.ndarray, any_copy: bool) -> np.ndarray:
    """Which keys stand at an earlier place too; with ``any_copy`` at any other place."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), dtype=bool)
    if len(keys):
        found[order[1:]] = same
        if any_copy:
            found[order[:-1]] |= same
    return found


def measure(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts per text; features, number of words and text of every line that has a word."""
    data, offsets = buffer_of(texts)
    n = len(texts)
    starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    points = _ranges((data & 0xC0) != 0x80, starts, ends)

    grams, at = windows(words, owner, WINDOW)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    twice = at[_again(mixed(grams + owner[at].astype(np.uint64)), any_copy=True)]
    marks[: len(words) + 1] += np.bincount(twice, minlength=len(words) + 1)
    marks -= np.bincount(twice + WINDOW, minlength=len(words) + 1)
    repeated = np.cumsum(marks[:-1]) > 0

    begin, end, text = line_spans(data, offsets)
    edges = np.searchsorted(starts, np.concatenate([begin, [len(data) + 1]]))
    line_words = np.diff(edges)
    used = line_words > 0
    first_word, last_word = edges[:-1][used], edges[1:][used] - 1
    begin, end, text, line_words = begin[used], end[used], text[used], line_words[used]
    lines = span_hashes(data, begin, end)
    copies = _again(mixed(lines + text.astype(np.uint64)), any_copy=False)

    counts = {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": np.bincount(owner, weights=points, minlength=n).astype(np.int64),
        "n_symbols": _ranges(_SYMBOL[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": np.bincount(text[copies], minlength=n),
        "n_repeat_words": np.bincount(owner[repeated], minlength=n),
    }
    word_sums = np.concatenate([[0], np.cumsum(points)])
    repeat_sums = np.concatenate([[0], np.cumsum(repeated)])
    chars = word_sums[last_word + 1] - word_sums[first_word]
    repeats = (repeat_sums[last_word + 1] - repeat_sums[first_word]) / np.maximum(line_words, 1)
    letters = np.maximum(_ranges(_LETTER[data], begin, end), 1)
    share = lambda table: _ranges(table[data], begin, end) / np.maximum(chars, 1)
    capitals = _ranges(_UPPER[data], begin, end) / letters
    symbols, length = share(_SYMBOL), chars / np.maximum(line_words, 1)
    closing = data[ends[last_word] - 1] if len(last_word) else np.zeros(0, np.uint8)
    features = np.stack(
        [
            np.ones(len(begin), dtype=bool), line_words <= 2, line_words <= 5, symbols > 0.02, symbols > 0.08,
            capitals > 0.25, capitals > 0.6, share(_DIGIT) > 0.1, share(_SHOUT) > 0.05, copies, repeats > 0.1,
            repeats > 0.5, closing == ord("."), length > 9, length < 3,
        ],
        axis=1,
    )
    return counts, features, line_words, text


# ---------------------------------------------------------------- conditional random field


class Field:
    """Weights of the field: one row of feature weights per label, and the weight of every pair of labels."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None) -> None:
        self.emit = np.zeros((2, len(FEATURES))) if emit is None else emit
        self.move = np.zeros((2, 2)) if move is None else move

    def decode(self, features: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Best label of every line (Viterbi); a tie goes to content. All texts advance together."""
        scores = features @ self.emit.T
        first = np.searchsorted(text, np.arange(n + 1))
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        labels, came = np.ones(len(text), dtype=np.int8), np.zeros((len(text), 2), dtype=np.int8)
        best = np.zeros((n, 2))
        for t in range(int(length.max(initial=0))):
            active = order[: int(np.searchsorted(-length[order], -t, side="left"))]
            at = first[active] + t
            if t == 0:
                best[active] = scores[at]
                continue
            offers = best[active][:, :, None] + self.move[None]  # before, now
            back = (offers[:, 1] >= offers[:, 0]).astype(np.int8)
            came[at] = back
            best[active] = np.where(back == 1, offers[:, 1], offers[:, 0]) + scores[at]
        now = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(int(length.max(initial=0)) - 1, -1, -1):
            active = order[: int(np.searchsorted(-length[order], -t, side="left"))]
            at = first[active] + t
            labels[at] = now[active]
            now[active] = came[at, now[active]]
        return labels

    def gradient(self, features: np.ndarray, mask: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean log-likelihood of padded sequences (sequence, line, feature)."""
        steps = features.shape[1]
        scores = features @ self.emit.T
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, steps):
            new = np.logaddexp.reduce(ahead[:, t - 1][:, :, None] + self.move, axis=1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = np.logaddexp.reduce(self.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None, None]
        single = np.exp(ahead + behind - total) * mask[:, :, None]
        truth = np.eye(2)[gold] * mask[:, :, None]
        emit = np.einsum("stl,stf->lf", truth - single, features)
        pair = ahead[:, :-1, :, None] + self.move + (scores + behind)[:, 1:, None, :] - total[..., None]
        both = mask[:, 1:, None, None]
        move = np.einsum("stab->ab", truth[:, :-1, :, None] * truth[:, 1:, None, :] - np.exp(np.where(both, pair, -np.inf)))
        return emit / mask.sum(), move / mask.sum()


_PIECE = 64  # lines of a training sequence; longer texts are cut


def fit(features: np.ndarray, text: np.ndarray, gold: np.ndarray, steps: int = 150) -> Field:
    """Fit to labelled lines, those of a text in order and together. Without lines all weights are 0."""
    field = Field()
    if not len(text):
        return field
    place = np.arange(len(text)) - np.searchsorted(text, text)
    _, sequence = np.unique(text * (place.max() // _PIECE + 1) + place // _PIECE, return_inverse=True)
    shape = (sequence.max() + 1, min(_PIECE, place.max() + 1))
    padded = np.zeros((*shape, features.shape[1]))
    mask, labels = np.zeros(shape, dtype=bool), np.zeros(shape, dtype=np.int64)
    at = (sequence, place % _PIECE)
    padded[at], mask[at], labels[at] = features, True, gold
    moments = [np.zeros_like(w) for w in (field.emit, field.move)]
    spread = [np.zeros_like(w) for w in (field.emit, field.move)]
    for step in range(1, steps + 1):
        gradients = field.gradient(padded, mask, labels)
        for w, g, m, v in zip((field.emit, field.move), gradients, moments, spread):
            g = g - 1e-4 * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", texts: int = SAMPLE_TEXTS) -> Field:
    """Fit on at most ``texts`` labelled texts. Rows with a null key or label take no part."""
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64(key), key)
        .limit(texts)
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                _, features, _, text = measure(part.column("text"))
                bits = features.astype(np.int64) @ (1 << np.arange(len(FEATURES), dtype=np.int64))
                gold = part.column("label").to_numpy(zero_copy_only=False)
                first = np.searchsorted(text, np.arange(part.num_rows + 1))
                per_text = [bits[a:b] for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "label": gold, "bits": per_text})

    rows = (
        docs.join(chosen, key)
        .select(F.col(key).cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("__label").alias("label"))
        .mapInArrow(lean(lines), "id string, label int, bits array<bigint>")
        .orderBy("id", "label", "bits")
        .collect()
    )
    bits = np.concatenate([np.array(r["bits"], dtype=np.int64) for r in rows] or [np.zeros(0, np.int64)])
    text = np.repeat(np.arange(len(rows)), [len(r["bits"]) for r in rows])
    gold = np.repeat([int(r["label"] > 0) for r in rows], [len(r["bits"]) for r in rows]).astype(np.int64)
    return fit((bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(float), text, gold)


def judge(df: DataFrame, field: Field, key: str = "doc_id", text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """Per row: key, the counts, ``base_failed``, ``content_words`` and ``kept``.

    A null text counts as empty; a text without words fails the base rules. Every row gives one row, so
    repeated rows are repeated. Other columns of ``df`` are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                counts, features, words, owner = measure(part.column("text"))
                content = field.decode(features, owner, part.num_rows) == 1
                held = np.bincount(owner[content], weights=words[content], minlength=part.num_rows)
                n = counts["n_words"]
                failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
                kept = ~failed & (held >= share * n)
                columns = [part.column("key"), *(pa.array(counts[c].astype(np.int64)) for c in names)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(failed), pa.array(held.astype(np.int64)), pa.array(kept)],
                    names=["key", *names, "base_failed", "content_words", "kept"],
                )

    fed = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = ", ".join([f"key {fed.dtypes[0][1]}", *(f"{c} bigint" for c in names)])
    judged = fed.mapInArrow(lean(run), f"{schema}, base_failed boolean, content_words bigint, kept boolean")
    return judged.withColumnRenamed("key", key)
