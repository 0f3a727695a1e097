"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded by fixed measurements and
a learned layer; gated attention (a tanh branch times a sigmoid branch) weighs the passages of a text; the
weighted sum is scored. Only texts carry labels, the weights of passages are learned from them.

The network is fitted on a bounded sample (``SAMPLE_TEXTS`` labelled texts, ``SAMPLE_PASSAGES`` of each, evenly
spaced: some 350 MB at most); scoring reads every passage of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import buffer_of, chunks, lean, mixed, span_hashes, windows, word_spans
from skyair.llm.rules import _again

#: Labelled texts used to fit the network; the first in order of a hash of their id.
SAMPLE_TEXTS = 6_000
#: Passages of a labelled text used to fit it; longer texts give evenly spaced ones.
SAMPLE_PASSAGES = 200
PASSAGE_WORDS = 50
HIDDEN = 24
ATTENTION = 12
THRESHOLD = 0.3

_BUCKETS = 32
_CLASSES = (*"#*$%&|<>!?.,;:-_=+/\\'\"()[]{}@", "A-Z", "a-z", "0-9", "other", "line", "beyond")
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS_OF[_b] = _CLASSES.index(
        _c if _c in _CLASSES else "beyond" if _b >= 0x80 else "A-Z" if _c.isupper() else "a-z" if _c.islower()
        else "0-9" if _c.isdigit() else "line" if _c == "\n" else "other"
    )
WIDTH = len(_CLASSES) + _BUCKETS + 6


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Measurements of every passage, and the text each belongs to; a text without words has one, all zero."""
    data, offsets = buffer_of(texts)
    n = len(texts)
    starts, ends, owner = word_spans(data, offsets)
    per_text = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    per_bag = np.maximum(1, -(-per_text // PASSAGE_WORDS))
    first = np.cumsum(per_bag) - per_bag
    passage = first[owner] + place // PASSAGE_WORDS
    total = int(per_bag.sum())
    out = np.zeros((total, WIDTH), dtype=np.float32)
    bag = np.repeat(np.arange(n), per_bag)
    if not len(owner):
        return out, bag
    words = np.bincount(passage, minlength=total)
    # Characters from the first word of a passage up to the first of the next.
    head = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    tail = np.append(head[1:], len(passage)) - 1
    lengths = ends[tail] - starts[head]
    inner = np.repeat(starts[head] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    cells = np.repeat(passage[head], lengths) * len(_CLASSES) + _CLASS_OF[data[inner]]
    classes = np.bincount(cells, minlength=total * len(_CLASSES)).reshape(total, -1)
    out[:, : len(_CLASSES)] = 4 * classes / np.maximum(classes.sum(axis=1, keepdims=True), 1)

    hashes = span_hashes(data, starts, ends)
    bucket = (hashes % np.uint64(_BUCKETS)).astype(np.int64)
    sign = ((hashes >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    sketch = np.bincount(passage * _BUCKETS + bucket, weights=sign, minlength=total * _BUCKETS)
    sketch = sketch.reshape(total, _BUCKETS)
    # Of length 1/2, so that one word said over and over does not drown the other measurements.
    out[:, len(_CLASSES) : len(_CLASSES) + _BUCKETS] = sketch / np.maximum(2 * np.linalg.norm(sketch, axis=1), 1e-9)[:, None]

    share = lambda flags: np.bincount(passage[flags], minlength=total) / np.maximum(words, 1)
    grams, at = windows(hashes, owner, 5)
    twice = at[_again(mixed(grams + owner[at].astype(np.uint64)), any_copy=True)]
    marked = np.zeros(len(hashes), dtype=bool)
    marked[twice] = True
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    size = np.bincount(passage, weights=ends - starts, minlength=total) / np.maximum(words, 1)
    spread = np.bincount(passage, weights=(ends - starts) ** 2, minlength=total) / np.maximum(words, 1)
    out[:, -6:] = np.stack(
        [
            2 * share(_again(mixed(hashes + passage.astype(np.uint64)), any_copy=False)), 2 * share(marked), 2 * share(same),
            np.log1p(words) / 4, size / 8, np.sqrt(np.maximum(spread - size**2, 0)) / 8,
        ],
        axis=1,
    )
    return out, bag


def spaced(begin: int, end: int, most: int = SAMPLE_PASSAGES) -> np.ndarray:
    """At most ``most`` of the places from ``begin`` to ``end``, the first and the last among them."""
    return np.unique(np.linspace(begin, end - 1, min(most, end - begin)).round().astype(np.int64))


class Network:
    def __init__(self, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        shapes = {"w": (WIDTH, HIDDEN), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION, 1), "c": (HIDDEN, 1)}
        self.p = {k: draw.normal(0, 1 / s[0] ** 0.5, s) for k, s in shapes.items()}
        self.p["b"], self.p["c0"] = np.zeros(HIDDEN), np.zeros(1)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """``first``: where each bag begins in ``x``; no bag is empty."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = ((t * s) @ p["a"])[:, 0]
        sizes = np.diff(np.append(first, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        weight = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(h * weight[:, None], first, axis=0)
        logit = (z @ p["c"])[:, 0] + p["c0"]
        return {"h": h, "t": t, "s": s, "weight": weight, "z": z, "sizes": sizes, "score": 1 / (1 + np.exp(-np.clip(logit, -50, 50)))}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, first)
        slope = ((f["score"] - y) / len(y))[:, None]
        dz = np.repeat(slope @ p["c"].T, f["sizes"], axis=0)
        through = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(through * f["weight"], first), f["sizes"])
        de = (f["weight"] * (through - mean))[:, None]
        gate = de @ p["a"].T
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (dz * f["weight"][:, None] + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        return {
            "c": f["z"].T @ slope, "c0": slope.sum(axis=0), "a": (f["t"] * f["s"]).T @ de, "v": f["h"].T @ dt,
            "u": f["h"].T @ ds, "w": x.T @ dh, "b": dh.sum(axis=0),
        }


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = 20, batch: int = 128, steps: int = 600, seed: int = 3) -> Network:
    """Adam on the log-likelihood of the labels of the bags, over ``epochs`` rounds or ``steps``, whichever is more."""
    net, draw = Network(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, rounds = 0, max(epochs, -(-steps // max(1, -(-len(bags) // batch))))
    for _ in range(rounds if bags else 0):
        order = draw.permutation(len(bags))
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            x = np.concatenate([bags[i] for i in some]).astype(np.float64)
            begin = np.cumsum([0, *(len(bags[i]) for i in some[:-1])])
            step += 1
            for name, g in net.gradients(x, begin, y[some]).items():
                g = g + 1e-4 * net.p[name]
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                net.p[name] -= 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", texts: int = SAMPLE_TEXTS) -> Network:
    """Fit on at most ``texts`` of the labelled texts in ``docs``. Null keys and labels take no part."""
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64(key), key)
        .limit(texts)
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                x, bag = passages(part.column("text"))
                edges = np.searchsorted(bag, np.arange(part.num_rows + 1))
                coded = [x[spaced(a, b)].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                columns = [part.column("id"), part.column("label"), pa.array(coded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "x"])

    rows = (
        docs.join(chosen, key)
        .select(F.col(key).cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("__label").alias("label"))
        .mapInArrow(lean(encode), "id string, label int, x binary")
        .orderBy("id", "label", "x")
        .collect()
    )
    bags = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(bags, np.array([float(r["label"] > 0) for r in rows]))


def score(df: DataFrame, net: Network, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` without its text, plus ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are one passage without words. Every row gives one row. Columns of ``df`` named
    like the results are replaced.
    """
    kept = [c for c in df.columns if c not in (text, "text", "score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                x, bag = passages(part.column("text"))
                first = np.searchsorted(bag, np.arange(part.num_rows))
                found = net.forward(x.astype(np.float64), first)["score"]
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                    names=[*kept, "score", "predicted"],
                )

    fed = df.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = [f"`{c}` {kind}" for c, kind in fed.drop("text").dtypes]
    return fed.mapInArrow(lean(run), ", ".join([*schema, "score double", "predicted int"]))
