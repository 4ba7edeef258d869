import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import toxicity as tox
from riskweave.llm.queries import op1_toxicity
from tests.llm.cases import LABELS, no_docs, odd_docs


def plain_score(model, text):
    """Noisy-or over sentences, computed directly."""
    clean = 1.0
    for s in tox.SENTENCE.findall(text or ""):
        if words := s.split():
            hits = {x for w in words for x in tox.slots(w) if x in model.weights}
            z = model.bias + sum(model.weights[x] for x in hits)
            clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 500
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.98
    assert np.mean([r.predicted for r in held if r.toxic == 1]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_scores_are_noisy_or_and_sentences_are_found(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = tox.ToxicityModel({next(iter(tox.slots("scum"))): 9.0, **dict.fromkeys(tox.slots("the"), 0.4)}, -5.0)
    for r in tox.score(docs.select("text"), model).collect():
        assert r.score == pytest.approx(plain_score(model, r.text), rel=1e-9, abs=1e-12)
    one = spark.createDataFrame([("A fine day. You scum of it! Bye",)], "text string")
    hit = tox.score(one, model).first()
    assert [r.text if hasattr(r, "text") else one.first().text[r.begin : r.end] for r in hit.offending] == [" You scum of it"]


def test_fit_recovers_the_offending_feature():
    # Documents of three sentences; feature 0 alone makes a document toxic.
    rng = np.random.default_rng(0)
    n = 400
    y = rng.integers(0, 2, n)
    doc_of = np.repeat(np.arange(n), 3)
    rows, cols = [], []
    for s in range(3 * n):
        rows += [s, s]
        cols += [1 + rng.integers(0, 3), 4 + rng.integers(0, 3)]
    for d in np.flatnonzero(y):
        rows.append(3 * d + rng.integers(0, 3))
        cols.append(0)
    w, b = tox.noisy_or_fit(y, np.zeros(n), doc_of, np.array(rows), np.array(cols), 7)
    assert w[0] > 4 and b < -2 and w[0] > 3 + np.abs(w[1:]).max()


def test_odd_rows(spark):
    model = tox.ToxicityModel({1: 3.0}, -4.0)
    docs = odd_docs(spark).withColumnsRenamed({"lang": "score", "source": "offending"})
    assert tox.score(docs, model).columns == ["doc_id", "text", "n_chars", "score", "offending"]
    rows = tox.score(docs, model, "t_").collect()
    assert len(rows) == 11
    assert {r.t_score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert all(r.t_score > 0 for r in rows if r.doc_id in (1, 2, 6, 7))
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 0), (2, 0, 0)], LABELS)
    assert tox.fit(odd_docs(spark), labels).weights == {}
    assert tox.fit(no_docs(spark), labels).weights == {}
    none = tox.score(odd_docs(spark), tox.ToxicityModel())
    assert {r.score for r in none.collect()} == {0.0}
    assert tox.score(no_docs(spark), model).collect() == []
    assert none.filter(F.size("offending") > 0).count() == 0
