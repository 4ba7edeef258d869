"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bloom_lm, decontaminate, hard_negatives, html_text, imatch, language_id, lexical, licenses, line_dedup, pieces, quality, simhash, toxicity
from riskweave.llm.common import id_crc, table
from riskweave.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_crc() % 3 == 1
    model = toxicity.fit(docs, labels, ~held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT_AT).cast("int").alias("predicted"),
        "offending",
    )


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_crc() % 4 == 2
    model = quality.fit(docs, labels, ~held_out)
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"),
    )


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("found").alias("f")).select(
        "doc_id",
        "f.item_id",
        F.col("f.score").alias("bm25"),
        F.col("f.question").alias("question_overlap"),
        F.col("f.answer").alias("answer_overlap"),
    )


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, check="round_trip").select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip"
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op3_bloom_lm")
def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", id_crc() % 7 == 2)
    return bloom_lm.score(docs, ~F.col("held_out"), least_pairs=1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_crc() % 4 == 2
    models = language_id.fit(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", "text"), models).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted"
    )


@query("op5_imatch")
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_texts(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op9_licenses", licenses.oracle())
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_line_dedup", line_dedup.ORACLE)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op13_hard_negatives", hard_negatives.ORACLE)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = hard_negatives.quantised(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine(points, F.col("vec_id") % 100 == 0)


@query("op11_lexical_search", lexical.ORACLE)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
