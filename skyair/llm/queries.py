"""Registered queries of the operators; the SQL stands next to the operator it checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.llm import (
    alignment,
    chat,
    decontamination,
    infill,
    jaccard,
    langid,
    linededup,
    lm,
    pieces,
    pii,
    quality,
    rules,
    sharding,
)
from skyair.llm.common import read_table, remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    prototypes = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), prototypes)


@query("op2_shard_placement", sharding.ORACLE)
def shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id"), sharding.lookup_table(spark), "doc_id")


@query("op3_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))


@query("op4_sentencepiece")
def sentencepiece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(read_table(spark, sf_dir, "documents"))


@query("op5_ngram_jaccard_join", jaccard.ORACLE)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read_table(spark, sf_dir, "documents"))


@query("op6_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 10) == 0)
    scored = lm.score(docs, lm.train(docs.filter(~F.col("held_out"))))
    results = [c for c in scored.columns if c != "doc_id"]
    return scored.select("doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), *results)


@query("op7_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    labels = read_table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    return quality.score(docs, quality.train(docs, labels))


@query("op8_decontamination", decontamination.ORACLE)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    field = rules.train(docs, read_table(spark, sf_dir, "labels"))
    return rules.judge(docs, field)


@query("op10_chat_formatting", chat.ORACLE)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.digest(chat.format_conversations(talks.unionByName(probe)))


@query("op11_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(read_table(spark, sf_dir, "documents"))


@query("op12_fill_in_middle", infill.ORACLE)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return infill.digest(infill.transform(docs))


@query("op13_line_dedup", linededup.ORACLE)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.apply(docs, linededup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
