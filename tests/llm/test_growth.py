"""What must not grow faster than the input, in the operators on texts."""

import random
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.helpers import shown_plan, tuples
from tests.llm.test_operators import table

import corpus_pipeline
from skyair.llm import common, decontamination, jaccard, pieces


def test_only_texts_with_a_hit_are_shuffled(spark, monkeypatch):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"well {text} then"), (2, "nothing of the kind is to be found here"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontamination.contaminated(docs, items)
        assert "LeftSemi, BuildRight" in shown_plan(found)
        rows = tuples(found)
        monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", 0)
        left_to_the_engine = decontamination.contaminated(docs, items)
        assert "LeftSemi" not in shown_plan(left_to_the_engine)
        assert rows == tuples(left_to_the_engine) == [(1, 7, 1, 1.0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def largest_batch(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    return docs.mapInArrow(sizes, "size bigint").agg(F.max("size")).first()[0]


@pytest.mark.parametrize("name", ["language_id", "near_duplicates", "sentencepiece"])
def test_a_stage_sends_its_texts_in_small_batches(spark, name):
    few = table(spark, [(1, "a few words of a text", "en"), (2, None, None)])
    many = spark.range(0, 4_000, 1, 1).select("id", F.repeat(F.lit("word "), 800).alias("text"))
    try:
        dict(corpus_pipeline.STAGES)[name](spark, few, "").collect()
        assert largest_batch(many) <= corpus_pipeline.BATCH_BYTES + 10_000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_the_pipeline_leaves_the_session_as_it_was(spark, tmp_path):
    table(spark, [(1, "a few words of a text", "en"), (2, None, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "an item")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "33m")
    try:
        corpus_pipeline.run(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "33m"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_shingles_take_little_memory_and_leave_none():
    words = np.random.default_rng(3).integers(0, 9_000, size=800_000)
    texts = [" ".join(map(str, words[k : k + 500])) for k in range(0, len(words), 500)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    common.give_back()
    tracemalloc.start()
    for part in common.chunks(batch, limit=jaccard.SLICE_BYTES):
        jaccard.shingle_sets(part.column("text"))
    common.give_back()
    left, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 24 << 20 and left < 2 << 20


def made_up_words(seed, n):
    letters = np.random.default_rng(seed).choice(list("etaoinshrdlu"), size=(n, 9))
    return ["".join(w) for w in letters]


def test_new_words_are_encoded_without_a_call_for_every_character():
    coder, text, calls = pieces.Coder(pieces.load_vocabulary()), " ".join(made_up_words(4, 20_000)), Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        ids = coder.encode(text)
    finally:
        sys.setprofile(None)
    assert coder.decode(ids) == text
    assert calls["call"] + calls["c_call"] < len(text)


def test_frequent_words_stay_when_the_cache_is_full(monkeypatch):
    monkeypatch.setattr(pieces, "_CACHED_BYTES", 400_000)
    coder, looked_up = pieces.Coder(pieces.load_vocabulary()), Counter()
    one, some = coder.best_path, getattr(coder, "best_paths", None)
    coder.best_path = lambda stretch: looked_up.update([stretch]) or one(stretch)
    coder.best_paths = lambda stretches: looked_up.update(stretches) or some(stretches)
    words = made_up_words(5, 20_000)
    for k in range(0, len(words), 100):
        coder.encode(" ".join(["frequent", *words[k : k + 100]]))
    assert looked_up["▁" + words[150]] == 1 and looked_up["▁frequent"] == 1
    # What is kept is bounded: some hundred of 20,000 words, not all.
    assert len(coder.recent) + len(coder.older) < 5_000


def test_paths_taken_together_are_those_taken_alone(monkeypatch):
    rng = random.Random(6)
    plain = ["a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "cab", "bcab", "é", "x" * 20, "\n", "c▁a", "日本"]
    for trial in range(40):
        own = ["▁", *rng.sample(plain, rng.randint(0, len(plain)))]
        if trial % 2:
            own = [p for p in own if p not in ("\n", "c▁a")]
        monkeypatch.setattr(pieces, "_COMMON", rng.choice([1, 3, 64]))
        monkeypatch.setattr(pieces, "_GROUP", rng.choice([5, 1 << 19]))
        monkeypatch.setattr(pieces, "_BLOCK", rng.choice([60, 1 << 19]))
        every = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), *own]
        scores = [0.0] * 257 + [-float(rng.randint(0, 3)) for _ in own]  # many ties
        coder = pieces.Coder(pieces.Vocabulary(every, scores, list(range(1, 257)), [False] * 257 + [True] * len(own)))
        texts = ["".join(rng.choices(["a", "b", "c", " ", "▁", "é", "\n", "日本", "🙂", "x" * 21], k=rng.randint(0, 30))) for _ in range(30)]
        for text, path in zip(texts, coder.encode_all(texts)):
            assert coder.decode(coder.encode(text)) == text and coder.proves(path, text)
        short = sorted((s for s in set(texts) if s), key=len, reverse=True)
        assert coder.best_paths(short) == [coder.best_path(s) for s in short]
