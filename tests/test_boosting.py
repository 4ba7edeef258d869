"""Boosted trees on bins: the definition node by node, runs that go on, odd tables."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import attribution as A
from riskweave.operators import boosting as B

NAMES = ["a", "b", "c"]
PARAMS = {"n_estimators": 2, "max_depth": 3, "num_leaves": 5, "learning_rate": 0.5, "reg_alpha": 0.3,
          "reg_lambda": 0.7, "min_child_samples": 4, "scale_pos_weight": 2.0}


def made(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(rng.integers(0, 12)), float(rng.integers(0, 5)), float(rng.normal())
        a = None if rng.random() < 0.2 else a
        c = math.nan if rng.random() < 0.1 else round(c, 1)
        y = int((a is None) * 1.5 + (b > 2) + c * (not math.isnan(c)) + rng.normal() > 1.2)
        rows.append((i, a, b, c, y))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").repartition(5)


def table(df):
    rows = df.orderBy("id").collect()
    x = np.array([[math.nan if r[n] is None else r[n] for n in NAMES] for r in rows])
    return x, np.array([r.y for r in rows], float)


def by_definition(x, y, p):
    """(trees as nested tuples, margins): every split of every node tried on the raw values."""
    w = np.where(y == 1, p["scale_pos_weight"], 1.0)
    margin = np.full(len(y), math.log(w[y == 1].sum() / w[y == 0].sum()))
    lam, alpha = p["reg_lambda"], p["reg_alpha"]
    out = []
    for _ in range(p["n_estimators"]):
        q = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (q - y) * 2**24) / 2**24, np.rint(w * q * (1 - q) * 2**24) / 2**24

        def strength(rows):
            return max(abs(g[rows].sum()) - alpha, 0) ** 2 / (h[rows].sum() + lam)

        def best(rows):
            found = []
            for f in range(x.shape[1]):
                v = x[:, f]
                for t in sorted({u for u in v[rows] if not math.isnan(u)}):
                    for missing_left in (False, True):
                        left = rows & ((v <= t) | (np.isnan(v) & missing_left))
                        right = rows & ~left
                        if missing_left and not np.isnan(v[rows]).any():
                            continue
                        if min(left.sum(), right.sum()) < p["min_child_samples"]:
                            continue
                        gain = round(0.5 * (strength(left) + strength(right) - strength(rows)), 9)
                        if gain > 0:
                            found.append((gain, -f, -t, -missing_left, left, right))
            return max(found, key=lambda e: e[:4], default=None)

        leaves = [(np.ones(len(y), bool), 0)]
        splits = []
        while len(leaves) < p["num_leaves"]:
            ready = [(best(rows), i) for i, (rows, d) in enumerate(leaves) if d < p["max_depth"]]
            ready = [(b, i) for b, i in ready if b]
            if not ready:
                break
            b, i = max(ready, key=lambda e: e[0][0])
            _, d = leaves.pop(i)
            leaves += [(b[4], d + 1), (b[5], d + 1)]
            splits.append((-b[1], bool(-b[3]), int(b[4].sum()), int(b[5].sum())))
        for rows, _ in leaves:
            total = g[rows].sum()
            margin[rows] += -math.copysign(max(abs(total) - alpha, 0), total) / (h[rows].sum() + lam) * p["learning_rate"]
        out.append(sorted(splits))
    return out, margin


def splits_of(tree):
    return sorted((f, bool(m), tree[left][6], tree[right][6]) for f, _, m, left, right, _, _ in tree if f >= 0)


@pytest.fixture(scope="module")
def df(spark):
    return made(spark, 300)


@pytest.fixture(scope="module")
def fitted(df):
    return B.boost(df, df, NAMES, PARAMS, "y", "id", patience=99)


def test_trees_follow_the_definition(df, fitted):
    m = replace(fitted)
    x, y = table(df)
    trees, margin = by_definition(x, y, PARAMS)
    assert [splits_of(t) for t in m.trees] == trees
    assert any(s[1] for t in trees for s in t)  # some missing values go left
    assert all(sum(n[0] < 0 for n in t) <= 5 for t in m.trees)
    m.best = 2
    got = [r.margin for r in m.score(df).orderBy("id").collect()]
    assert got == pytest.approx(margin.tolist(), abs=1e-9)
    for p, auc in m.history:
        m.best = p
        s = np.array([r.margin for r in m.score(df).orderBy("id").collect()])
        diff = s[y == 1][:, None] - s[y == 0][None, :]
        assert auc == pytest.approx(((diff > 0) + 0.5 * (diff == 0)).mean())


def test_a_run_that_goes_on_ends_with_the_same_trees(spark, tmp_path):
    df, val = made(spark, 200), made(spark, 120, seed=2)
    params = {**PARAMS, "subsample": 0.7, "colsample_bytree": 0.6}
    whole = B.boost(df, val, NAMES, {**params, "n_estimators": 3}, "y", "id", patience=99, block=3)
    part = B.boost(df.repartition(2), val, NAMES, {**params, "n_estimators": 1}, "y", "id", patience=99, block=1)
    part.save(str(tmp_path / "model"))
    loaded = B.Ensemble.load(spark, str(tmp_path / "model"))
    assert loaded == part
    on = B.boost(df, val, NAMES, {**params, "n_estimators": 3}, "y", "id", patience=99, block=1, start=loaded)
    assert on.trees[:1] == part.trees and on.trees == whole.trees and on.history == whole.history
    with pytest.raises(ValueError):
        B.boost(df, val, NAMES, {**params, "max_depth": 2}, "y", "id", start=loaded)


def test_the_stop_wastes_less_than_a_block(spark):
    df, val = made(spark, 200), made(spark, 60, seed=3)
    m = B.boost(df, val, NAMES, {**PARAMS, "n_estimators": 30, "learning_rate": 1.0, "max_depth": 1}, "y", "id", patience=2, block=2)
    assert len(m.trees) < 30 and m.best + 2 <= len(m.trees) <= m.best + 2 + 1
    upto = [e for e in m.history if e[0] <= m.best + 2]  # what comes after the stop does not count
    assert m.best == max(upto, key=lambda e: (e[1], -e[0]))[0]


def test_parts_add_up_with_missing_values(df, fitted):
    m = fitted
    parts = A.tree_attribution(df, "id", NAMES, m.forest())
    base = m.base + A.expected_margin(m.forest())
    both = parts.withColumn("total", sum((F.col(n) for n in NAMES), F.lit(base))).select("id", "total")
    assert both.join(m.score(df), "id").filter(F.abs(F.col("total") - F.col("margin")) > 1e-9).count() == 0


def test_many_values_are_cut_into_bins(spark):
    df = spark.range(5000).selectExpr("id", "cast(id as double) as a", "cast(id % 3 as double) as b",
                                      "cast(null as double) as c", "cast(id >= 2500 as int) as y")
    edges = B.find_edges(df, NAMES)
    assert 200 <= len(edges[0]) <= 254 and edges[0] == sorted(edges[0]) and edges[0][-1] == math.inf
    assert edges[1] == [0.0, 1.0, math.inf] and edges[2] == [math.inf]
    m = B.boost(df, df, NAMES, {"n_estimators": 1, "max_depth": 1}, "y", "id")
    assert m.trees[0][0][0] == 0 and abs(m.edges[0][m.trees[0][0][1]] - 2500) < 40


def test_odd_tables(spark):
    df = made(spark, 60).coalesce(1)
    none = B.boost(df.limit(0), df, NAMES, {"n_estimators": 1}, "y", "id")
    assert [len(t) for t in none.trees] == [1] and none.score(df).filter("probability != 0.5").count() == 0
    one = B.boost(df.withColumn("y", F.lit(1)), df.limit(0), NAMES, {"n_estimators": 2}, "y", "id")
    assert one.best == 2 and one.history == [] and one.score(df).filter("probability < 0.9").count() == 0
    empty = B.boost(df.withColumn("a", F.lit(None).cast("double")), df, ["a"], {"n_estimators": 1}, "y", "id")
    assert [len(t) for t in empty.trees] == [1]
    twice = B.boost(df.withColumn("y", F.when(F.col("id") > 9, F.col("y"))), df, NAMES, {"n_estimators": 1}, "y", "id")
    assert twice.trees[0][0][6] == 50  # rows without a label take no part


def test_wide_levels_take_several_passes(df, fitted, monkeypatch):
    monkeypatch.setattr(B, "CELLS", 256 * 3)  # one node a pass
    got = B.boost(df, df, NAMES, {**PARAMS, "n_estimators": 1}, "y", "id", patience=99)
    assert got.trees == fitted.trees[:1]
