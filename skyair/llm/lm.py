"""Language-model scoring by partial matching over bytes.

A trie holds how often each byte, or the end of a text, followed each context of up to five bytes. A symbol
is coded in the longest known context; where the context has not seen it, an escape is coded first, and
the symbols of that context are left out of the counts of the next shorter one. Each symbol seen gives half
a count to the escape. Below the empty context all symbols left are equally
likely. The score of a text is the sum of log10 probabilities of its bytes and its end, with the counts
gathered from the training texts (pretrained, not adapted while a text is read).

A-Z are lower-cased; contexts and symbols are bytes as they stand. The counts of all contexts of all
training texts are a Spark table. Two bounded shortcuts travel to the tasks: the most frequent contexts
(``LONG_CONTEXTS``), used where the whole five bytes are among them, and the most frequent five-byte
contexts with their symbol (``FREQUENT_GRAMS``). Every other symbol leaves its task as a row (document,
context and symbol, times) and is joined to its exact probability through a shuffle. What training has
seen after its five bytes needs one count and one total; for what it has not, the different
(context, symbol) are joined to the counts of all six lengths.

Next to it stands a plain word model. Its frequent words, a bounded number, travel to the tasks that read
the texts; all other words are joined to their counts through a shuffle. Words are told apart by a 64-bit
hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyair.llm.common import LOWER, buffer_of, chunks, lean, mixed, span_hashes, stored, stored_in, word_spans
from skyair.sources.folders import remove

END = 256
SYMBOLS = 257
#: Longest context in bytes. A sixth byte triples the counts.
ORDER = 5
#: Contexts of each length; the context of length k is the remainder of the longest one modulo CONTEXTS[k].
CONTEXTS = tuple(256**k for k in range(ORDER + 1))
#: Every context up to this length is among the frequent ones.
SHORT = 2
#: Longer contexts sent to every task: at most this many, the most frequent.
LONG_CONTEXTS = 1 << 16
#: Five-byte contexts with symbol sent to every task: at most this many, the most frequent; 16 bytes each.
FREQUENT_GRAMS = 1 << 20
#: Words sent to every task: at most this many, the most frequent; 16 bytes each.
FREQUENT_WORDS = 1 << 18

_GRAM, _WORD, _TEXT = 0, 1, 2
_HELD = 1 << 21  # entries a counting task holds before it hands them on


def symbols_in_context(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every symbol of all texts: number of its longest context, the symbol, the text it belongs to.

    A text is read as if ORDER line ends stood before it.
    """
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    padded = np.full(len(data) + (ORDER + 1) * n, 0x0A, dtype=np.int64)
    padded[np.arange(len(data)) + (ORDER + 1) * owner + ORDER] = data
    padded[offsets[1:] + (ORDER + 1) * np.arange(1, n + 1) - 1] = END
    as_byte = np.where(padded == END, 0x0A, padded)
    last = max(0, len(padded) - ORDER)
    context = np.zeros(last, dtype=np.int64)
    for place in range(ORDER):
        context = context * 256 + as_byte[place : place + last]
    symbol_owner = np.repeat(np.arange(n), np.diff(offsets) + ORDER + 1)
    whole = symbol_owner[:last] == symbol_owner[ORDER:]
    return context[whole], padded[ORDER:][whole], symbol_owner[ORDER:][whole]


class _Tally:
    """Counts of 64-bit keys."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts))
        self.size += len(found)
        if self.size > _HELD:
            self.parts = [self.taken()]
            self.size = len(self.parts[0][0])

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(counts, first)


def corpus_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often every (context, symbol) and every word occurs: rows (kind, item, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind: int, tally: _Tally) -> Iterator[pa.RecordBatch]:
            keys, counts = tally.taken()
            for k in range(0, len(keys), 1 << 16):
                some = keys[k : k + (1 << 16)]
                kinds = np.full(len(some), kind, dtype=np.int8)
                yield pa.RecordBatch.from_pydict({"kind": kinds, "item": some, "n": counts[k : k + (1 << 16)]})

        grams, words, texts = _Tally(), _Tally(), 0
        for batch in batches:
            for part in chunks(batch):
                context, symbol, _ = symbols_in_context(part.column("text"))
                grams.add(context << 9 | symbol)
                data, offsets = buffer_of(part.column("text"))
                data = LOWER[data]
                starts, ends, _ = word_spans(data, offsets)
                words.add(span_hashes(data, starts, ends).view(np.int64))
                texts += part.num_rows
                if words.size > _HELD // 2:
                    yield from rows(_WORD, words)
                    words = _Tally()
                if grams.size > _HELD // 2:
                    yield from rows(_GRAM, grams)
                    grams = _Tally()
        yield from rows(_GRAM, grams)
        yield from rows(_WORD, words)
        if texts:
            yield pa.RecordBatch.from_pydict(
                {"kind": np.array([_TEXT], np.int8), "item": np.zeros(1, np.int64), "n": np.array([texts], np.int64)}
            )

    return (
        df.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
        .mapInArrow(lean(count), "kind tinyint, item bigint, n bigint")
        .groupBy("kind", "item")
        .agg(F.sum("n").alias("n"))
    )


class Contexts(NamedTuple):
    """The kept contexts: which row each has, and the log10 probability of every symbol in each row."""

    short: np.ndarray  # row of every context of SHORT bytes
    long: list[list[tuple[np.ndarray, np.ndarray, int]]]  # per longer length: tables of (context, row) by place
    column: np.ndarray  # column of every symbol
    table: np.ndarray

    def coded(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol in its longest kept context."""
        rows = self.short[context % CONTEXTS[SHORT]]
        for length, tables in enumerate(self.long, start=SHORT + 1):
            own = context % CONTEXTS[length]
            for keys, found, salt in tables:
                place = _place(own, salt, len(keys))
                hit = keys[place] == own
                rows[hit] = found[place[hit]]
        return self.table[rows, self.column[symbol]]

    def whole(self, context: np.ndarray) -> np.ndarray:
        """Where all of the context is kept, so that no longer one is missing."""
        held = np.zeros(len(context), dtype=bool)
        for keys, _, salt in self.long[-1]:
            held |= keys[_place(context, salt, len(keys))] == context
        return held


def _place(context: np.ndarray, salt: int, size: int) -> np.ndarray:
    return ((context * (0x9E3779B97F4A7C15 - (salt << 17) - 2**64)) >> 33) & (size - 1)


def _lookup(contexts: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Hash tables that together hold every context; what finds its place taken goes to the next table."""
    tables = []
    while len(contexts):
        size = 1 << max(4, int(len(contexts) * 4).bit_length())
        keys, found = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
        place = _place(contexts, len(tables), size)
        keys[place], found[place] = contexts, rows
        tables.append((keys, found, len(tables)))
        left = keys[place] != contexts
        contexts, rows = contexts[left], rows[left]
    return tables


def contexts_of(order: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Contexts:
    """Probabilities from counts of (length of context, context, symbol).

    Of the contexts that are listed every shorter one has to be listed too.
    """
    used = np.unique(symbol)
    column = np.full(SYMBOLS, len(used), dtype=np.int64)  # symbols that never occur share the last column
    column[used] = np.arange(len(used))
    never = SYMBOLS - len(used)
    seen, counts = [], []
    for length in range(ORDER + 1):
        own = order == length
        listed, row = np.unique(context[own], return_inverse=True)
        table = np.zeros((len(listed), len(used)), dtype=np.float32)
        np.add.at(table, (row, column[symbol[own]]), n[own])
        seen.append(listed)
        counts.append(table)

    out = [np.full((1, len(used) + 1), -np.log10(SYMBOLS), dtype=np.float32)]  # where nothing was counted
    first_row, base = [], 1
    for length in range(ORDER + 1):
        first_row.append(base)
        base += len(seen[length])
        for k in range(0, len(seen[length]), 2048):
            some = seen[length][k : k + 2048]
            chance, escape = np.zeros((len(some), len(used) + 1)), np.ones(len(some))
            excluded = np.zeros((len(some), len(used)), dtype=bool)
            for shorter in range(length, -1, -1):
                table = counts[shorter][np.searchsorted(seen[shorter], some % CONTEXTS[shorter])]
                usable = (table > 0) & ~excluded
                kinds = usable.sum(axis=1)
                whole = np.maximum((table * usable).sum(axis=1, dtype=np.float64), 1)
                chance[:, :-1] += usable * (table - 0.5) * (escape / whole)[:, None]
                escape = np.where(kinds > 0, escape * kinds / (2 * whole), escape)
                excluded |= usable
            left = never + (~excluded).sum(axis=1)
            chance[:, :-1] += ~excluded * (escape / np.maximum(left, 1))[:, None]
            chance[:, -1] = escape / np.maximum(left, 1)
            out.append(np.log10(np.maximum(chance, 1e-300)).astype(np.float32))
    short = np.zeros(CONTEXTS[SHORT], dtype=np.int32)
    for length in range(SHORT + 1):
        every = np.arange(CONTEXTS[SHORT]) % CONTEXTS[length]
        if len(seen[length]):
            place = np.minimum(np.searchsorted(seen[length], every), len(seen[length]) - 1)
            short = np.where(seen[length][place] == every, first_row[length] + place, short).astype(np.int32)
    long = [
        _lookup(seen[k], np.arange(first_row[k], first_row[k] + len(seen[k]), dtype=np.int32))
        for k in range(SHORT + 1, ORDER + 1)
    ]
    return Contexts(short, long, column, np.concatenate(out))


def most_frequent(df: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the largest ``n``, at most ``most`` of them; rows of about equal ``n`` stay together.

    A histogram in steps of 1/8 of a doubling, 512 rows at most, gives the threshold.
    """
    step = F.floor(F.log2(n) * 8).cast("int")
    lowest, taken = 1_000, 0
    for row in sorted(df.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        taken += row["count"]
        if taken > most:
            break
        lowest = row["step"]
    return df.filter(step >= lowest)


def _by_length(items: DataFrame, *others: str) -> DataFrame:
    """Per ``item`` six rows (length, context, symbol), one for each length of context."""
    sizes = [F.struct(F.lit(k).alias("length"), F.lit(v).cast("bigint").alias("size")) for k, v in enumerate(CONTEXTS)]
    symbol = F.col("item").bitwiseAND(511).cast("int").alias("symbol")
    rows = items.select("item", *others, symbol, F.explode(F.array(*sizes)).alias("l"))
    context = F.shiftright("item", 9) % F.col("l.size")
    return rows.select("item", *others, F.col("l.length").alias("length"), context.alias("context"), "symbol")


def all_contexts(grams: DataFrame) -> DataFrame:
    """Counts (length, context, symbol, n) of all contexts, from counts (item, n)."""
    counts = _by_length(grams, "n").groupBy("length", "context", "symbol").agg(F.sum("n").alias("n"))
    return stored(counts, "lm-contexts")


def kept_contexts(by_length: DataFrame, long_contexts: int = LONG_CONTEXTS) -> DataFrame:
    """The counts of the frequent contexts."""
    totals = by_length.filter(F.col("length") > SHORT).groupBy("length", "context").agg(F.sum("n").alias("total"))
    long = most_frequent(totals, "total", long_contexts)
    return by_length.filter(F.col("length") <= SHORT).unionByName(
        by_length.join(long.select("length", "context"), ["length", "context"], "left_semi")
    )


def unseen(items: DataFrame, by_length: DataFrame) -> DataFrame:
    """Rows (item, value): log10 probability of items that training has not seen, from counts of all lengths."""
    levels = _by_length(items)
    node = ["length", "context"]
    own = by_length.join(levels.select(node).distinct(), node, "left_semi")
    sizes = F.array(*(F.lit(v).cast("bigint") for v in CONTEXTS))
    shorter = F.col("context") % F.get(sizes, F.greatest(F.col("length") - 1, F.lit(0)))
    above = by_length.select((F.col("length") + 1).alias("length"), F.col("context").alias("shorter"), "symbol", F.col("n").alias("above"))
    # A context's symbols are all seen after the next shorter one too: ``above`` is what they count there.
    nodes = own.withColumn("shorter", shorter).join(above, ["length", "shorter", "symbol"], "left").groupBy(node).agg(
        F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).cast("double").alias("kinds"),
        F.coalesce(F.sum("above"), F.lit(0)).cast("double").alias("above"),
    )
    nodes, folder = stored_in(nodes, "lm-nodes")
    met = levels.join(nodes, node).join(by_length, [*node, "symbol"], "left")
    chain = F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("k"), "total", "kinds", "above", "n")))
    start = F.struct(F.lit(0.0).alias("log"), F.lit(False).alias("done"), F.lit(0.0).alias("above"), F.lit(0.0).alias("kinds"))

    def step(state, level):
        whole, kinds = level["total"] - state["above"], level["kinds"] - state["kinds"]
        log = (
            F.when(state["done"], state["log"])
            .when(level["n"].isNotNull(), state["log"] + F.log10((level["n"] - 0.5) / whole))
            .when(kinds > 0, state["log"] + F.log10(kinds / (2 * whole)))
            .otherwise(state["log"])
        )
        return F.struct(
            log.alias("log"), (state["done"] | level["n"].isNotNull()).alias("done"),
            level["above"].alias("above"), level["kinds"].alias("kinds"),
        )

    end = lambda state: F.when(state["done"], state["log"]).otherwise(state["log"] - F.log10(SYMBOLS - state["kinds"]))
    found = met.groupBy("item").agg(chain.alias("chain"))
    found = stored(found.select("item", F.aggregate("chain", start, step, end).alias("value")), "lm-unseen")
    remove(found.sparkSession, folder)
    return found


class Model(NamedTuple):
    contexts: Contexts
    frequent: np.ndarray  # hashes of the frequent words, ascending
    frequent_counts: np.ndarray
    grams: np.ndarray  # the frequent five-byte contexts with symbol, ascending
    grams_log: np.ndarray
    counts: DataFrame  # (gram, word, value): log10 of the count of all words, log10 probability of all grams seen
    by_length: DataFrame  # counts of all contexts
    train_tokens: int
    vocabulary: int
    texts: int


def _ascending(df: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    rows = df.select(key, value).toArrow()
    keys, values = np.asarray(rows.column(key)), np.asarray(rows.column(value))
    order = np.argsort(keys)
    return keys[order], values[order]


def train(
    df: DataFrame, text: str = "text", frequent_words: int = FREQUENT_WORDS, long_contexts: int = LONG_CONTEXTS,
    frequent_grams: int = FREQUENT_GRAMS,
) -> Model:
    counts = stored(corpus_counts(df, text), "lm-counts")
    words = counts.filter(F.col("kind") == _WORD).select(F.col("item").alias("word"), F.col("n").alias("c"))
    n_words, n_tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    texts = sum(r["n"] for r in counts.filter(F.col("kind") == _TEXT).collect())
    keys, c = _ascending(most_frequent(words, "c", frequent_words), "word", "c")
    grams = counts.filter(F.col("kind") == _GRAM).select("item", "n")
    by_length = all_contexts(grams)
    kept = kept_contexts(by_length, long_contexts).toArrow()
    contexts = contexts_of(*(np.asarray(kept.column(k), dtype=np.int64) for k in ("length", "context", "symbol", "n")))
    # A window holds the symbols of one context, SYMBOLS at most.
    total = F.sum("n").over(Window.partitionBy(F.shiftright("item", 9)))
    seen = stored(grams.withColumn("value", F.log10((F.col("n") - 0.5) / total)), "lm-seen")
    items, logs = _ascending(most_frequent(seen, "n", frequent_grams), "item", "value")
    values = seen.select(F.lit(True).alias("gram"), F.col("item").alias("word"), "value").unionByName(
        words.select(F.lit(False).alias("gram"), "word", F.log10(F.col("c") + 0.1).alias("value"))
    )
    return Model(contexts, keys, c, items, logs, values, by_length, n_tokens + texts, n_words + (texts > 0), texts)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    A null text counts as empty: one token, its end. Rows are told apart by key and text, so repeated rows
    give repeated results, and rows with a null key are kept. Without training texts every word is
    unknown and every symbol equally likely. Other columns of ``df`` are ignored.
    """
    spark = df.sparkSession
    end_log, end_known = float(np.log10(model.texts + 0.1)), int(model.texts > 0)
    shared = spark.sparkContext.broadcast(
        (model.contexts, model.frequent, np.log10(model.frequent_counts + 0.1), model.grams, model.grams_log)
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, frequent, frequent_log, grams, grams_log = shared.value
        for batch in batches:
            for part in chunks(batch):
                n = part.num_rows
                context, symbol, owner = symbols_in_context(part.column("text"))
                item = context << 9 | symbol
                coded = contexts.coded(context, symbol).astype(np.float64)
                met = contexts.whole(context)
                if len(grams):
                    open_ = np.flatnonzero(~met)
                    place = np.minimum(np.searchsorted(grams, item[open_]), len(grams) - 1)
                    listed = grams[place] == item[open_]
                    coded[open_[listed]] = grams_log[place[listed]]
                    met[open_[listed]] = True
                code_length = np.bincount(owner[met], weights=coded[met], minlength=n) + 0.0
                rare_gram, gram_owner = item[~met], owner[~met]
                data, offsets = buffer_of(part.column("text"))
                digest = span_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)
                data = LOWER[data]
                starts, ends, owner = word_spans(data, offsets)
                words = span_hashes(data, starts, ends).view(np.int64)
                place = np.searchsorted(frequent, words)
                place[place == len(frequent)] = 0
                known = frequent[place] == words if len(frequent) else np.zeros(len(words), dtype=bool)
                logs = np.bincount(owner[known], weights=frequent_log[place[known]], minlength=n) + end_log
                n_known = np.bincount(owner[known], minlength=n) + end_known
                tokens = np.bincount(owner, minlength=n) + 1
                is_gram = np.repeat([False, True], [np.count_nonzero(~known), len(rare_gram)])
                rare = np.concatenate([words[~known], rare_gram])
                rare_owner = np.concatenate([owner[~known], gram_owner])
                order = np.lexsort((rare, is_gram, rare_owner))
                rare, rare_owner, is_gram = rare[order], rare_owner[order], is_gram[order]
                first = np.flatnonzero(
                    np.concatenate([[True], (rare[1:] != rare[:-1]) | (is_gram[1:] != is_gram[:-1]) | (rare_owner[1:] != rare_owner[:-1])])
                ) if len(rare) else np.zeros(0, dtype=np.int64)
                times = np.diff(np.append(first, len(rare)))
                source = np.concatenate([np.arange(n), rare_owner[first]])
                is_text = np.arange(len(source)) < n
                filled = lambda values: pa.array(np.concatenate([values, np.zeros(len(first), values.dtype)]), mask=~is_text)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(source)),
                        pa.array(digest[source]),
                        # A text's own row carries no word; a number of its own spreads these rows.
                        pa.array(np.concatenate([mixed(digest.view(np.uint64) + np.arange(n, dtype=np.uint64)).view(np.int64), rare[first]])),
                        pa.array(np.concatenate([np.zeros(n, bool), is_gram[first]])),
                        pa.array(np.concatenate([np.zeros(n, np.int64), times])),
                        filled(tokens), filled(n_known), filled(logs), filled(code_length),
                    ],
                    names=["key", "digest", "word", "gram", "times", "tokens", "known", "logs", "coded"],
                )

    kind = df.select(F.col(f"`{key}`").alias("key")).dtypes[0][1]
    fed = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    read_rows = fed.mapInArrow(
        lean(read),
        f"key {kind}, digest bigint, word bigint, gram boolean, times bigint, tokens bigint, known bigint, logs double, coded double",
    )
    read_rows = stored(read_rows, "lm-rows")
    missing = read_rows.filter("gram").select(F.col("word").alias("item")).distinct().join(
        model.counts.filter("gram").select(F.col("word").alias("item")), "item", "left_anti"
    )
    missing, folder = stored_in(missing, "lm-missing")
    if model.texts:
        found = unseen(missing, model.by_length)
        remove(spark, folder)
    else:
        found = missing.withColumn("value", F.lit(-float(np.log10(SYMBOLS))))
    values = model.counts.unionByName(found.select(F.lit(True).alias("gram"), F.col("item").alias("word"), "value"))
    joined = read_rows.join(values, ["gram", "word"], "left")
    rare_word = ~F.col("gram") & (F.col("times") > 0)
    summed = joined.groupBy("key", "digest").agg(
        F.count("tokens").alias("rows"),
        F.sum("tokens").alias("tokens"),
        (F.sum("known") + F.sum(F.when(rare_word & F.col("value").isNotNull(), F.col("times")).otherwise(0))).alias("known"),
        (F.sum("logs") + F.sum(F.when(rare_word, F.col("times") * F.coalesce("value", F.lit(-1.0))).otherwise(0.0))).alias("logs"),
        (F.sum("coded") + F.sum(F.when(F.col("gram"), F.col("times") * F.col("value")).otherwise(0.0))).alias("coded"),
    )
    whole = float(np.log10(model.train_tokens + 0.1 * (model.vocabulary + 1)))
    per_row = lambda name: (F.col(name) / F.col("rows"))
    return summed.select(
        F.col("key").alias(key),
        per_row("tokens").cast("bigint").alias("n_tokens"),
        per_row("known").cast("bigint").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (per_row("logs") - per_row("tokens") * whole).alias("base_score"),
        per_row("coded").alias("score"),
        F.explode(F.array_repeat(F.lit(True), F.col("rows").cast("int"))).alias("__row"),
    ).drop("__row")

