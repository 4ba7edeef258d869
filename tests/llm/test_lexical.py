import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import lexical as lx
from tests.llm.cases import ODD, no_docs, odd_docs


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, top):
    """Every document scored for every item; docs and items are (id, text)."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, own in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(i, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def found(docs, items, top):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in lx.search(docs, items, top).collect()], key=repr)


@pytest.mark.parametrize("block, seeds, bucket", [(1 << 14, 4096, 1024), (60, 20, 8), (1, 1, 1024)])
def test_against_all_scores(spark, monkeypatch, block, seeds, bucket):
    for name, value in (("BLOCK_TERMS", block), ("SEEDS", seeds), ("SEED_SHARE", 0.0), ("BUCKET", bucket)):
        monkeypatch.setattr(lx, name, value)
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    docs = [(i // 2 if i % 10 == 0 else i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 3, 30, 200])))) for i in range(300)]
    docs += [(None, "W1 w2"), (None, "w149"), (900, None), (901, "-- !!"), (902, "w140 w141"), (903, "w140 w141")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(6)]
    items += [(3, "w7, W8!"), (None, "w9 w10"), (None, "w11"), (50, None), (51, "..."), (52, "unknown words"), (53, "w140 w141")]
    if block == 1:
        items = items[4:7]
    got = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), 7)
    assert got == plain(docs, items, 7)


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumns({"score": F.lit(1), "size": F.lit(2), "norm": F.lit(3), "item_id": F.lit(4)})
    items = [(1, "Fox and the dog; a ROW"), (2, "é straße 東京 ÄÖÜ word5"), (3, "nul x00")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    assert found(docs, asked, 50) == plain([r[:2] for r in ODD], items, 50)
    assert found(no_docs(spark), asked, 50) == [] == found(docs, asked.limit(0), 50)
    named = spark.createDataFrame([("a", "fox")], "item_id string, text string")
    assert {r.item_id for r in lx.search(docs, named).collect()} == {"a"}


def test_bounds_skip_work_and_lose_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    documents, width = 600, 40
    tf = rng.integers(1, 9, (documents, width)) * (rng.random((documents, width)) < rng.random((documents, 1)) ** 3)
    corpus = lx.Corpus(rng.integers(1, 4000, width), documents, int(tf.sum()))
    items = lx.Items(None, np.arange(width, dtype=np.uint64), [np.sort(rng.choice(width, 12, replace=False)) for _ in range(8)])
    sizes = tf.sum(axis=1)
    impact = np.where(tf > 0, lx.impacts(tf, sizes[:, None], corpus.documents, corpus.total), 0)
    rows = [np.flatnonzero(r) for r in tf]
    norm = np.sqrt((impact.astype(float) ** 2 * corpus.weights).sum(axis=1))
    batch = lx.pa.RecordBatch.from_pydict({"doc_id": np.arange(documents), "size": sizes, "terms": [r.astype(np.int32) for r in rows], "tf": [tf[i, r].astype(np.int32) for i, r in enumerate(rows)], "norm": norm})
    looked = []
    ask = lx.Search._ask
    monkeypatch.setattr(lx.Search, "_ask", lambda self, i, table, *a: (looked.append(len(table)), ask(self, i, table, *a)))
    monkeypatch.setattr(lx, "BUCKET", 16)
    search = lx.Search(items, corpus, np.ones(8, np.int64), 5)
    search.add(batch)
    for i, terms in enumerate(items.terms):
        ids, score = search.settle(i)
        want = impact[:, terms] @ corpus.weights[terms]
        best = np.lexsort((np.arange(documents), -want))[:5]
        assert ids.tolist() == best.tolist() and score.tolist() == want[best].tolist()
    assert sum(looked) < 0.7 * documents * 8
