import numpy as np
from pyspark.sql import functions as F

from riskweave.llm import quality as q
from riskweave.llm.common import labelled_sample
from riskweave.llm.queries import op7_quality
from tests.llm.cases import LABELS, no_docs, odd_docs


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    rows = op7_quality(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 500
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_vote_against_brute_force():
    rng = np.random.default_rng(3)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    known, asked = unit(rng.normal(size=(200, 8))), unit(rng.normal(size=(50, 8)))
    known[50:60] = known[40:50]  # ties
    labels = rng.integers(0, 2, 200).astype(np.float32)
    model = q.QualityModel({}, np.zeros(0), np.zeros((0, 8)), known, labels)
    got = model.vote(np.concatenate([asked, known[40:50]]))
    for v, share in zip(np.concatenate([asked, known[40:50]]), got, strict=True):
        sims = known @ v
        order = sorted(range(200), key=lambda i: (-sims[i], i))[: q.NEIGHBOURS]
        weight = np.maximum(sims[order], 0)
        assert abs((weight * labels[order]).sum() / weight.sum() - share) < 1e-5


def test_sample_is_bounded_and_takes_all_of_a_rare_class(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 100 == 0).cast("int").alias("quality"))
    n = {r.y: r["count"] for r in labelled_sample(docs, labels.union(labels), "quality", None, 500).groupBy("y").count().collect()}
    assert n[1] == 40 and 380 < n[0] < 540


def test_shapes():
    assert q.shape("Word.") == "Aa0." and q.shape("WORD!!") == "A0!!" and q.shape("|") == "p|"
    assert q.shape("a***") == "a0***" and q.shape("12") == "00"


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (8, None, 0), (None, 1, 1)], LABELS)
    model = q.fit(odd_docs(spark), labels)
    rows = q.score(odd_docs(spark).withColumn("score", F.lit(1)), model, "s2").collect()
    assert len(rows) == 11
    assert {r.s2 for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert len({r.s2 for r in rows if r.doc_id in (1, 2)}) == 1
    none = q.fit(no_docs(spark), labels)
    assert {r.score for r in q.score(odd_docs(spark), none).collect()} == {0.0, 0.5}
    assert q.score(no_docs(spark), model).collect() == []
