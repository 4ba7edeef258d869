import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import imbalance as I
from riskweave.operators import neighbours as N
from riskweave.operators.split import class_balance

FEATURES = ["f0", "f1", "f2"]


def frame(spark, x, label=1):
    rows = [(i, *map(float, r), label) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "TransactionID bigint, f0 double, f1 double, f2 double, isFraud int")


def brute(x, k):
    out = {}
    for i, a in enumerate(x):
        d = ((a - x) ** 2).sum(axis=1)
        order = sorted((d[j], j) for j in range(len(x)) if j != i)[:k]
        out[i] = [j for _, j in order]
    return out


def clusters(seed=0):
    """A tight ball, a wide cloud, far outliers, and a third of all rows one and the same."""
    rng = np.random.default_rng(seed)
    return np.concatenate([
        np.tile([5.0, 5.0, 5.0], (70, 1)),
        rng.normal(0, 0.01, (60, 3)),
        rng.normal(0, 20, (70, 3)),
        [[1e5, 0, 0], [-1e5, 3, 9]],
    ])


def test_neighbours_are_exact_on_skewed_data(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAF_ROWS", 8)
    x = clusters()
    got = {}
    for r in I.nearest(frame(spark, x), "TransactionID", FEATURES, 5).collect():
        got.setdefault(r["TransactionID"], {})[r["rank"]] = r["neighbour"]
    want = brute(x, 5)
    assert {i: [v[k] for k in sorted(v)] for i, v in got.items()} == want


def test_fewer_rows_than_neighbours(spark):
    x = np.array([[0, 0, 0], [1, 0, 0], [5, 0, 0]])
    got = I.nearest(frame(spark, x), "TransactionID", FEATURES, 5).collect()
    assert len(got) == 6


def imbalanced(spark, n=500, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, *map(float, rng.normal(size=3)), int(rng.random() < 0.035)) for i in range(n)]
    return spark.createDataFrame(rows, "TransactionID bigint, f0 double, f1 double, f2 double, isFraud int")


def test_guard(spark):
    with pytest.raises(AssertionError, match="train_only"):
        I.smote(imbalanced(spark), FEATURES, 0.1, train_only=False)


def test_resampled_share(spark):
    df = imbalanced(spark)
    before = class_balance(df).first()
    out = I.smote(df, FEATURES, 0.1, train_only=True)
    after = class_balance(out).first()
    assert after["n_negative"] == before["n_negative"]
    assert after["n_positive"] == int(before["n_negative"] * 0.1) > before["n_positive"]
    assert out.columns == ["TransactionID", *FEATURES, "isFraud"]
    assert out.filter(" or ".join(f"{f} is null or isnan({f})" for f in FEATURES)).count() == 0


def test_synthetic_rows_lie_between_minority_rows(spark):
    df = imbalanced(spark)
    lo, hi = df.filter("isFraud = 1").agg(F.min("f0"), F.max("f0")).first()
    new = I.smote(df, FEATURES, 0.2, train_only=True).filter("TransactionID is null")
    assert new.filter((F.col("f0") < lo) | (F.col("f0") > hi)).count() == 0


def test_same_rows_on_a_second_run(spark):
    df = imbalanced(spark)
    a, b = (sorted(I.smote(x, FEATURES, 0.2, train_only=True).collect(), key=str) for x in (df, df.repartition(7)))
    assert a == b


def test_class_weights(spark):
    df = spark.range(1000).select((F.col("id") < 35).cast("int").alias("isFraud"))
    w = I.positive_weight(df)
    assert w == pytest.approx(965 / 35)
    assert I.class_weight_map(w) == {0: 1.0, 1: w}
    got = {r["isFraud"]: r["weight"] for r in I.balanced_weights(df).collect()}
    assert got == {0: pytest.approx(1000 / (2 * 965)), 1: pytest.approx(1000 / 70)}
    with pytest.raises(ValueError):
        I.positive_weight(df.filter("isFraud = 0"))


@pytest.mark.parametrize("leaf", [8, 64, 2000])
def test_neighbours_with_two_valued_columns(spark, monkeypatch, leaf):
    """Eight columns, five of them two-valued: exact for any leaf size."""
    monkeypatch.setattr(N, "LEAF_ROWS", leaf)
    monkeypatch.setattr(N, "BLOCK_BYTES", 5_000)
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 2, (300, 5)) * 100.0, rng.normal(size=(300, 3))])
    names = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "k long, " + ", ".join(f"{n} double" for n in names))
    got = {}
    for r in I.nearest(df, "k", names, 3).collect():
        got.setdefault(r.k, {})[r["rank"]] = r.neighbour
    for i in range(300):
        d = ((x - x[i]) ** 2).sum(axis=1)
        order = sorted((j for j in range(300) if j != i), key=lambda j: (d[j], j))[:3]
        assert [got[i][p] for p in (1, 2, 3)] == order


@pytest.mark.parametrize("spread", [1.0, 1e6])
def test_neighbours_in_forty_columns(spark, monkeypatch, spread):
    """Many columns, some far from zero, hubs and ties: exact, and stored rows stay k a vector."""
    monkeypatch.setattr(N, "LEAF_ROWS", 60)
    monkeypatch.setattr(N, "BLOCK_BYTES", 100_000)
    written = []
    real = N.stored
    monkeypatch.setattr(N, "stored", lambda df, name="table": (lambda out: (written.append((name, out)), out)[1])(real(df, name)))
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(900, 40)), 1) + spread * (np.arange(40) % 3 == 0)
    x[:300] = x[0] + 0.1 * rng.integers(0, 2, (300, 40))
    names = [f"f{i}" for i in range(40)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "k long, " + ", ".join(f"{n} double" for n in names))
    got = {}
    for r in I.nearest(df, "k", names, 4).collect():
        got.setdefault(r.k, {})[r["rank"]] = r.neighbour
        assert list(r.neighbour_row) == x[r.neighbour].tolist()
    distinct = len(np.unique(x, axis=0))
    for i in range(900):
        d = N.squared(np.repeat(x[i : i + 1], 900, axis=0), x)
        order = sorted((j for j in range(900) if j != i), key=lambda j: (d[j], j))[:4]
        assert [got[i][p] for p in (1, 2, 3, 4)] == order
    assert all(out.count() <= 5 * distinct + 900 for _, out in written)


def test_boxes_and_rounds_spare_work():
    """Where the data has structure, few products are looked at; where not, results per task stay few."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 3))
    tree = N.Tree.cut(x, 50)
    leaf = tree.leaf_of(x)
    assert np.bincount(leaf).max() <= 50
    search = N.Search(np.arange(300), x[:300], np.full(300, np.inf), 6)
    own = [np.flatnonzero(leaf == i) for i in np.unique(leaf)]
    for mine in own:
        asked = mine[mine < 300]
        first = N.Search(asked, x[asked], np.full(len(asked), np.inf), 6)
        first.add(mine, x[mine])
        first.settle()
        search.reach[asked] = first.reach
    for mine in own:
        search.add(mine, x[mine])
    assert search.looked < 0.15 * 300 * 6000
    of, keys, _ = search.settle()
    for i in range(300):
        d = ((x - x[i]) ** 2).sum(axis=1)
        assert keys[of == i].tolist() == np.argsort(d, kind="stable")[:6].tolist()


def test_copies_are_searched_once_and_by_all_cores(spark, monkeypatch):
    """Copies of a vector are no further points, and the cells lie in files for several tasks."""
    monkeypatch.setattr(N, "LEAF_ROWS", 8)
    written = {}
    real = N.stored
    monkeypatch.setattr(N, "stored", lambda df, name="table": written.setdefault(name, real(df, name)) if name == "cells" else real(df, name))
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(64, 3)), 9, axis=0)[rng.permutation(576)]
    got = {}
    for r in I.nearest(frame(spark, x), "TransactionID", FEATURES, 12).collect():
        got.setdefault(r["TransactionID"], {})[r["rank"]] = r["neighbour"]
    assert {i: [v[k] for k in sorted(v)] for i, v in got.items()} == brute(x, 12)
    assert written["cells"].count() == 64
    assert len(written["cells"].inputFiles()) > 1


def test_products_choose_the_pairs_of_a_cell(monkeypatch):
    """Without a known distance, few exact distances are computed, and ties and order hold."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(700, 40)), rng.integers(0, 2, (300, 40))]) + 1e6
    pairs = []
    real = N.squared
    monkeypatch.setattr(N, "squared", lambda a, b: (pairs.append(len(a)), real(a, b))[1])
    search = N.Search(np.arange(1000), x, np.full(1000, np.inf), 6)
    search.add(np.arange(1000), x)
    of, keys, d2 = search.settle()
    assert sum(pairs) < 0.1 * 1000 * 1000
    for i in range(0, 1000, 7):
        d = real(np.repeat(x[i : i + 1], 1000, axis=0), x)
        order = np.lexsort((np.arange(1000), d))[:6]
        assert keys[of == i].tolist() == order.tolist()
        assert d2[of == i].tolist() == d[order].tolist()


@pytest.mark.parametrize("few", [0, 2000])
def test_repeated_and_missing_keys(spark, monkeypatch, few):
    """A row that repeats its key counts twice for others and not for itself; rows without a key take no part."""
    monkeypatch.setattr(I, "FEW_ROWS", few)
    x = np.random.default_rng(6).normal(size=(30, 3))
    x[20:] = x[:10]
    rows = frame(spark, x)
    no_key = frame(spark, x[:3]).withColumn("TransactionID", F.lit(None).cast("bigint"))
    got = {}
    for r in I.nearest(rows.unionByName(rows).unionByName(no_key), "TransactionID", FEATURES, 5).collect():
        got.setdefault(r["TransactionID"], []).append((r["rank"], r["neighbour"]))
    want = brute(x, 3)
    for i in range(30):
        others = np.repeat(want[i], 2)[: 4 if few else 5].tolist()
        assert sorted(got[i]) == sorted(2 * list(enumerate(others, 1)))
