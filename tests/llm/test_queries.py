"""The registered queries over a whole small table: against their SQL, or a plain version where SQL cannot say it."""

import hashlib
import inspect
import zlib
from collections import Counter

import duckdb
import pytest
from tests.llm import brute

import __spark_entry__ as contract
import corpus_pipeline
from skyair.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def rows(spark):
    kept = {}

    def of(name):
        if name not in kept:
            df = QUERIES[name](spark, SF_DIR)
            kept[name] = df.columns, df.collect()
        return kept[name]

    return of


def test_all_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    for q in QUERIES.values():
        assert list(inspect.signature(q).parameters) == ["spark", "sf_dir"]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(duck, rows, name):
    columns, found = rows(name)
    cursor = duck.execute(ORACLES[name])
    listed = [c[0] for c in cursor.description]
    assert sorted(listed) == sorted(columns)
    expected = Counter(tuple(r[listed.index(c)] for c in columns) for r in cursor.fetchall())
    assert Counter(map(tuple, found)) == expected and expected


def held_out(i, modulus, value):
    return zlib.crc32(str(i).encode()) % modulus == value


def test_language_of_held_out_texts(duck, rows):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = [r for r in rows("op1_language_id")[1] if r.held_out]
    assert {r.doc_id for r in found} == {i for i in langs if held_out(i, 4, 2)}
    assert sum(r.lang_pred == langs[r.doc_id] for r in found) / len(found) > 0.97


def test_personal_data(rows, texts):
    found = rows("op3_pii")[1]
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_pieces_decode_to_every_text(rows, texts):
    found = rows("op4_sentencepiece")[1]
    assert {r.doc_id for r in found} == set(texts) and all(r.exact and r.n_ids >= 1 for r in found)


def test_language_model(rows, texts):
    counts = brute.word_model([t for i, t in texts.items() if not held_out(i, 10, 0)])
    found = rows("op6_lm_scoring")[1]
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        tokens, known, n, base = brute.base_score(counts, texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(r.doc_id, 10, 0), tokens, known, n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    # The bytes of held-out prose cost well under what they would without a model (8 bits, 2.4 in log10).
    own = [r for r in found if r.held_out]
    assert sum(-r.score for r in own) / sum(len(texts[r.doc_id].encode()) + 1 for r in own) < 1.0


@pytest.mark.parametrize("name, verdict, modulus", [("op7_quality_classifier", "predicted", 5), ("op9_quality_rules", "kept", None)])
def test_quality_of_labelled_texts(duck, rows, name, verdict, modulus):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    found = [r for r in rows(name)[1] if r.doc_id in labels]
    if modulus:
        found = [r for r in found if r.held_out]
    good = [r for r in found if labels[r.doc_id] and not (verdict == "kept" and r.base_failed)]
    bad = [r for r in found if not labels[r.doc_id]]
    assert sum(int(r[verdict]) for r in good) >= 0.95 * len(good) and sum(int(r[verdict]) for r in bad) <= 0.3 * len(bad)


def test_quality_counts(rows, texts):
    for r in rows("op9_quality_rules")[1]:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute.quality_counts(texts[r.doc_id])


def test_aligned_tokens(rows, texts):
    expected = brute.alignments(texts)
    found = rows("op11_cross_tokenizer_alignment")[1]
    assert {r.doc_id: r.asDict() for r in found} == {i: {"doc_id": i, **v} for i, v in expected.items()}
    assert sum(v["n_groups"] > 0 for v in expected.values()) > 0.9 * len(texts)


def test_pipeline(spark, duck, texts):
    """Each stage against a plain version of what it decides, on what the one before it kept."""
    from tests.llm.test_operators import plain_join

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert 4 <= len(stages) <= 5 and list(stages)[0] == "language_id"
    from skyair.llm.common import stored

    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for k, (name, stage) in enumerate(stages.items()):
        docs = stored(stage(spark, docs, SF_DIR), name)
        if k < len(stages) - 1:
            assert docs.columns == columns
            seen.append({r.doc_id: r.text for r in docs.collect()})
    assert seen[1] == {i: t for i, t in seen[0].items() if any(c.isalpha() for c in t or "")}
    classes = plain_join(list(seen[1].items()))
    assert set(seen[2]) == {i for i, (c, _, _) in classes.items() if c == i} and len(seen[2]) < len(seen[1])
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    leaked = {d for d, _ in brute.leaks(list(seen[2].items()), items)}
    assert set(seen[3]) == set(seen[2]) - leaked and leaked
    assert set(seen[4]) == set(seen[3])
    for i, text in seen[4].items():
        held = brute.base_spans(seen[3][i])
        assert (text == seen[3][i]) == (not held) and not brute.base_spans(text)
    last = docs.collect()
    assert {r.doc_id for r in last} == set(seen[4]) and all(r.exact for r in last)
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(last)
