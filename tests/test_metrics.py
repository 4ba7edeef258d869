import numpy as np
import pytest

from riskweave.operators import metrics as M


def brute(y, s):
    """AP, AUC, KS, best F1 and threshold straight from the definitions."""
    ts = np.unique(s)[::-1]
    P, N = y.sum(), (1 - y).sum()
    tp = np.array([y[s >= t].sum() for t in ts])
    fp = np.array([(1 - y)[s >= t].sum() for t in ts])
    p, r = tp / (tp + fp), tp / P
    ap = np.sum(np.diff(np.concatenate([[0], r])) * p)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    ks = np.max(np.abs(r - fp / N))
    f1 = 2 * tp / (tp + fp + P)
    best = f1.max()
    return ap, auc, ks, best, ts[f1 == best].min()


def scored(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")


@pytest.mark.parametrize("n_ranges", [None, 300])
@pytest.mark.parametrize("seed", [0, 1])
def test_against_definitions(spark, seed, n_ranges):
    rng = np.random.default_rng(seed)
    y = (rng.random(400) < 0.2).astype(int)
    s = np.round(rng.random(400), 2)  # many ties
    s[:130] = 0.25  # a third of all rows on one score
    ap, auc, ks, f1, thr = brute(y, s)
    curve = M.score_curve(scored(spark, y, s), n_ranges=n_ranges)
    assert M.average_precision(curve).first()[0] == pytest.approx(ap)
    assert M.roc_auc(curve).first()[0] == pytest.approx(auc)
    assert M.ks_statistic(curve).first()[0] == pytest.approx(ks)
    row = M.best_threshold(curve).first()
    assert (row["f1"], row["threshold"]) == (pytest.approx(f1), pytest.approx(thr))


def test_bundle_on_separable_scores(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(200) < 0.05).astype(int)
    y[0] = 1
    s = np.where(y == 1, rng.uniform(0.5, 1, 200), rng.uniform(0, 0.5, 200))
    row = M.risk_metrics(scored(spark, y, s), "smote", 777).first().asDict()
    assert list(row) == ["auc_pr", "auc_roc", "f1", "f2", "precision", "recall", "ks_statistic",
                         "threshold", "training_rows", "test_rows", "imbalance_strategy"]
    for name in ("auc_pr", "auc_roc", "f1", "f2", "precision", "recall", "ks_statistic"):
        assert row[name] == pytest.approx(1.0)
    assert (row["training_rows"], row["test_rows"], row["imbalance_strategy"]) == (777, 200, "smote")


def test_given_threshold(spark):
    df = scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.3, 0.1])
    row = M.risk_metrics(df, "none", 0, threshold=0.5).first()
    assert (row["precision"], row["recall"], row["threshold"]) == (0.5, 0.5, 0.5)
    none = M.risk_metrics(df, "none", 0, threshold=0.95).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_keyed_curves(spark):
    rng = np.random.default_rng(5)
    y, s = (rng.random(300) < 0.3).astype(int), rng.random(300)
    k = np.where(np.arange(300) % 3 == 0, "a", "b")
    df = spark.createDataFrame([(str(c), int(a), float(b)) for c, a, b in zip(k, y, s)], "k string, y int, score double")
    out = {r["k"]: r["auc_roc"] for r in M.roc_auc(M.score_curve(df, keys=["k"], n_ranges=40), ["k"]).collect()}
    for c in "ab":
        assert out[c] == pytest.approx(brute(y[k == c], s[k == c])[1])


def test_empty_denominators(spark):
    cells = M.confusion(scored(spark, [0, 0], [0.1, 0.2]), 0.5)
    assert tuple(M.threshold_metrics(cells).first()) == (0.0, 0.0, 0.0, 0.0)
