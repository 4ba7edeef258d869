import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=10, positives=5, negatives=5, low=80):
    """All rows of the result, by every score; ``rows``: (vec_id, embedding, label), at most one anchor an id."""
    held = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((vec_id, [max(-hn.LIMIT, min(hn.LIMIT, math.floor(256 * float(np.float32(x))))) for x in vector], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    last = lambda i: (i is None, i or 0)
    out, seen = [], {}
    for a in held:
        if a[0] is not None and a[0] % every == 0:
            seen[a[0]] = min(seen.get(a[0], a), a, key=lambda r: (r[2], r[1]))
    for a in seen.values():
        scored = sorted(((dot(a[1], r[1]), r[0], r[2]) for r in held if r[0] != a[0]), key=lambda x: (-x[0], last(x[1])))
        for ps, pid, _ in [x for x in scored if x[2] == a[2]][:positives]:
            window = [x for x in scored if x[2] != a[2] and low * ps <= 100 * x[0] <= 100 * ps][:negatives]
            out += [(a[0], pid, i + 1, nid, ps, ns) for i, (ns, nid, _) in enumerate(window)]
    return sorted(out, key=repr)


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"q": F.lit(1), "w": F.lit(2), "score": F.lit("x")}).repartition(3)
    out = hn.mine(hn.quantised(df), F.col("vec_id") % every == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("block", [hn.BLOCK_BYTES, 2_000])
def test_against_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "BLOCK_BYTES", block)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 40))
    rows = [(i, (centres[i % 6] * rng.uniform(0, 1.5) + rng.normal(size=40)).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 500


def test_ties_odd_vectors_and_few_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0, -1.0]) for _ in range(rng.choice([0, 1, 3, 3]))], rng.randint(0, 2)) for i in range(90)]
    rows += [(200 + i, [1.0, 1.0, 1.0], i % 3) for i in range(60)]  # equal vectors
    rows += [(300, None, 1), (310, [1.0], None), (320, [float("nan")], 1), (330, [float("inf"), 1.0], 1), (340, [None, 1.0], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (None, [0.9, 1.0], 2), (350, [1e30, -3e38], 0), (351, [1e30], 1), (352, [2e30, 1.0], 0)]
    rows += [(360, [1.0, 0.5], 1), (360, [1.0, 0.5], 1), (360, [0.5, 0.5], 1)]  # one id, several rows
    rows += [(400, [1.0, 1.0], 9)]  # no other row of its label
    got = mined(spark, rows)
    assert got == plain(rows)
    assert not any(r[0] in (300, 310, 320, 330, 340, 400) for r in got)
    assert mined(spark, [(0, [1.0], 1), (None, [1.0], 1), (None, [0.9], 2)]) == [(0, None, 1, None, 65536, 58880)]
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]
    assert mined(spark, rows, positives=1, negatives=20, low=0) == plain(rows, 10, 1, 20, 0)


def test_the_index_leaves_out_and_loses_nothing():
    rng = np.random.default_rng(2)
    rows, anchors = np.floor(rng.normal(size=(700, 64)) * 40), np.floor(rng.normal(size=(30, 64)) * 40)
    score = anchors @ rows.T
    for share in (0.1, 0.3, 0.5, 0.9):
        low = share * np.sqrt((anchors**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1)).max()
        least = float((low / np.sqrt((anchors**2).sum(axis=1))).min())
        index = hn.Index(rows, least)
        a, r = index.candidates(anchors, low)
        pairs = set(zip(a.tolist(), index.order[r].tolist(), strict=True))
        want = set(zip(*(x.tolist() for x in np.nonzero(score >= low[:, None])), strict=True))
        assert want <= pairs and len(pairs) < 0.5 * score.size
        assert index.out.sum() > 0.1 * share * rows.size
    assert hn.Index(rows, 1e9).size == 0
