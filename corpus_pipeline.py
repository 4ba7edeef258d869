"""Corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept:

1. toxicity: documents that score ``toxicity.REJECT_AT`` or more go.
2. quality: documents that score below ``quality.REJECT_BELOW`` go.
3. simhash: of each group of near-duplicates (four words a shingle, four bits at most) the document
   with the smallest doc_id stays.
4. decontaminate: documents that hold a benchmark item go.
5. sentencepiece: the ids of each document, and whether they decode to its text again.

The first four return the columns of ``documents``, extra ones included.

Defined cases: a null text is empty; an empty text is not toxic, but has no quality and goes in
stage 2; rows without doc_id are judged like others in stages 1, 2 and 4, and stay in stage 3,
as no group can be named by them; rows that repeat a doc_id are one document, of which stage 3
keeps one row; empty tables pass through; without labels nothing is rejected as toxic, and
every document has the undecided quality 0.5 and goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontaminate, pieces, quality, simhash, toxicity
from riskweave.llm.common import free_name, table
from riskweave.session import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    prefix = free_name(docs, "toxicity_", ("score", "offending"))
    scored = toxicity.score(docs, model, prefix)
    return scored.filter(F.col(f"{prefix}score") < toxicity.REJECT_AT).select(docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality_", ("score",)) + "score"
    scored = quality.score(docs, model, name)
    return scored.filter(F.col(name) >= quality.REJECT_BELOW).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(docs, words=4, radius=4)
    # Rows without id are in no group's name; they need not meet the ids that go.
    nameless = docs.filter("doc_id is null")
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    kept = docs.filter("doc_id is not null").join(gone, "doc_id", "left_anti").select(docs.columns)
    # Rows that repeat a kept id: few ids, so only their rows are compared.
    twice = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = twice.select("doc_id")
    if twice.isEmpty():
        return kept.union(nameless)
    once = kept.join(twice, "doc_id", "left_anti").select(docs.columns)
    again = kept.join(twice, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return once.union(again).union(nameless)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "benchmark_", ("items",)) + "items"
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"), name)
    return found.filter(F.size(name) == 0).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = pieces.encode(docs.select("doc_id", "text"), check="round_trip")
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("simhash", drop_copies),
    ("decontaminate", drop_leaks),
    ("sentencepiece", encode),
]

#: The models of stages 1 and 2 and the machine of stage 5 cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
