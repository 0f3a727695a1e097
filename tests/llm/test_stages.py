"""Every stage of the pipeline on odd rows: empty tables, null ids and texts, repeated rows, clashing columns."""

import pytest
from pyspark.sql import functions as F
from tests.llm.test_operators import CLASHING, table

import corpus_pipeline

EN = "The quick brown fox jumps over the lazy dog while the old farmer looks on from his field"
ITEM = "what is the capital city of the country that lies to the north of the long river"
MAIL = "please write to someone at jo.doe@example.org before the end of the week or call again later"
ROWS = [
    (1, EN, "en"),
    (1, EN, "en"),
    (2, EN, "en"),
    (None, EN + " but nobody else saw it happen on that day", "en"),
    (None, None, None),
    (3, None, "en"),
    (4, "", None),
    (5, MAIL, "en"),
    (5, MAIL, "en"),
    (6, f"question: {ITEM} answer", "en"),
    (None, f"again: {ITEM} yes", None),
    (7, "x" * 9_000 + " end", None),
    (8, "zqx wvk jqz xkv qzj vwx kqz jxv zzq wqx kvj", None),
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(1, ITEM), (2, None), (None, "an item without a number that is long enough to be compared")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def docs(spark):
    clashing = table(spark, ROWS).withColumn("lang_pred", F.lit("x")).withColumn("n_letters", F.lit(1)).withColumn("found", F.lit(2))
    return clashing.repartition(3).cache()


STAGES = dict(corpus_pipeline.STAGES)
KEPT = {  # ids that stay, with how often; None: rows without an id
    "language_id": {1: 2, 2: 1, None: 2, 5: 2, 6: 1, 7: 1, 8: 1},
    "near_duplicates": {1: 2, None: 3, 3: 1, 4: 1, 5: 2, 6: 1, 7: 1, 8: 1},
    "benchmark_decontamination": {1: 2, 2: 1, 3: 1, 4: 1, 5: 2, 7: 1, 8: 1},
    "personal_data": {1: 2, 2: 1, None: 3, 3: 1, 4: 1, 5: 2, 6: 1, 7: 1, 8: 1},
    "sentencepiece": {1: 2, 2: 1, None: 3, 3: 1, 4: 1, 5: 2, 6: 1, 7: 1, 8: 1},
}


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_rows(spark, docs, sf_dir, name):
    out = STAGES[name](spark, docs, sf_dir)
    rows = out.collect()
    if name != "sentencepiece":
        assert out.columns == docs.columns
        assert all(r.lang_pred == "x" and r.found == 2 and r.score == "x" for r in rows)
    counts = {}
    for r in rows:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    if name == "language_id":
        counts.pop(7, None), counts.pop(8, None)  # whether noise passes is tested with its operator
        assert counts == {k: v for k, v in KEPT[name].items() if k not in (7, 8)}
    else:
        assert counts == KEPT[name]
    if name == "personal_data":
        assert all("@" not in (r.text or "") for r in rows) and any("<EMAIL>" in (r.text or "") for r in rows)


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_an_empty_table(spark, sf_dir, name):
    assert STAGES[name](spark, spark.createDataFrame([], CLASHING), sf_dir).collect() == []
