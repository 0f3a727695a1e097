"""From raw documents to token ids: five stages, each applied to what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``docs``, whatever these are called. An empty table
gives an empty table in every stage.

A stage whose tasks run Python limits the session's Arrow batches to ``BATCH_BYTES``, as its frame is computed
after it has returned; ``run`` puts the setting back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.llm import decontamination, jaccard, langid, pieces, pii
from skyair.llm.common import read_table, stored

#: Bytes of an Arrow batch. A task holds one in the JVM, in buffers of twice its size, and two in its Python worker,
#: whatever slices the operator cuts; at Spark's 64 MB that is most of what a worker takes.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage``, with texts sent to its Python workers in batches of ``BATCH_BYTES``; rows are the same."""

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return limited


@_in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are in no language: texts without a letter, and texts no nearer to any language than noise.

    Rows with a null id or label are judged like all others, repeated rows each; a table without labelled
    rows has no language, so nothing is left of it.
    """
    names = {c: f"_{k}" for k, c in enumerate(docs.columns)}  # names of their own, so that none clashes with a result
    labelled = langid.predict(docs.withColumnsRenamed(names), langid.train(docs), names["text"], keep_text=True)
    kept = labelled.filter((F.col("lang_pred") != langid.UNKNOWN) & langid.in_a_language())
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of copies and near copies.

    Ids are whole numbers. Rows without an id stay, as no smaller one can be named; rows that share an id are
    one document and stay or go together; null, empty and wordless texts are in no group and stay.
    """
    return jaccard.keep_one(docs, jaccard.join(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item.

    All rows of an id go if one of them does, and so do rows without an id; null and empty texts hold no item
    and, having an id of their own, stay. Items without a text match nothing.
    """
    found = decontamination.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return decontamination.clean(docs, found)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rewrites the texts that hold personal data; keeps every row, repeated ones and null texts too."""
    return pii.sanitise(docs)


@_in_small_batches
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text; a null text counts as empty."""
    return pieces.encode_and_prove(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

#: The stages are no SQL; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = spark.conf.get(_BATCH_SETTING, None)
    try:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)
    return docs
