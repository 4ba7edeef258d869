"""Order primitives for several bracket sizes and numbers of ranges, on skewed and tied data."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.operators import order as o
from riskweave.operators import split
from riskweave.sources.fixtures import with_history


def frame(spark, values, name="x"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"{name} double")


def skewed(n=3000, seed=1):
    """A third of all values equal, the rest spread widely."""
    rng = np.random.default_rng(seed)
    v = np.concatenate([np.full(n // 3, 7.0), rng.lognormal(0, 3, n - n // 3)])
    rng.shuffle(v)
    return v


@pytest.mark.parametrize("limit", [None, 0, 50])
def test_quantiles_exact(spark, limit):
    v = skewed()
    probs = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    df = frame(spark, [*v, None]).withColumn("empty", F.lit(None).cast("double"))
    got = {(r["column"], r["prob"]): r for r in o.quantile_table(df, ["x", "empty"], probs, limit).collect()}
    for p in probs:
        assert got["x", p]["value"] == pytest.approx(np.quantile(v, p), rel=1e-12)
        assert got["x", p]["n"] == len(v)
        assert got["empty", p]["value"] is None and got["empty", p]["n"] == 0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_ranks_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    ranks = [0, len(values) // 2, len(values) - 1]
    s = sorted(values)
    for limit in (None, 0):
        got = o.values_at_ranks(df, "x", ranks, len(values), limit=limit)
        assert got == [(s[r], sum(v < s[r] for v in s), s.count(s[r])) for r in ranks]


@pytest.mark.parametrize("n_ranges", [None, 200])
def test_grouped_quantiles_with_hot_key(spark, n_ranges):
    v = skewed()
    keys = np.where(np.arange(len(v)) % 3 == 0, "hot", np.char.add("k", (np.arange(len(v)) % 40).astype(str)))
    rows = [(str(k), float(x)) for k, x in zip(keys, v)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = o.grouped_quantiles(df, ["k"], ["x"], [0.25, 0.5], n_ranges).collect()
    assert len(got) == 2 * len(set(keys))
    for r in got:
        mine = [x for k, x in rows if k == r["k"]]
        assert r["n"] == len(mine)
        assert r["value"] == pytest.approx(np.quantile(mine, r["prob"]), rel=1e-12)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_ranges(spark, descending):
    v = sorted(set(skewed().tolist()))
    df = spark.createDataFrame([(x, i + 1) for i, x in enumerate(v)], "x double, w bigint")
    edges = o.range_edges(df, ["x"], 32)["x"]
    assert len(edges) > 8
    out = o.running_totals(df, "x", ["w"], descending=descending, edges=edges).collect()
    weights = np.arange(1, len(v) + 1)
    cum = np.cumsum(weights[::-1])[::-1] if descending else np.cumsum(weights)
    assert {r["x"]: r["cum_w"] for r in out} == dict(zip(v, cum.tolist()))
    assert {r["total_w"] for r in out} == {weights.sum()}


def test_boundary_splits_a_tie(spark):
    rows = [(i, 5 if i < 80 else i) for i in range(100)]  # 80 rows share one time
    df = spark.createDataFrame(rows, "TransactionID bigint, TransactionDT bigint")
    for rank in (0, 1, 33, 80, 90, 100):
        (b,) = split.time_boundaries(df, [rank], 100)
        head = [r[0] for r in df.filter(split.in_head(b)).select("TransactionID").collect()]
        assert sorted(head) == list(range(rank))


@pytest.mark.parametrize("limit", [0])
def test_boundary_by_narrowing(spark, monkeypatch, limit):
    monkeypatch.setattr(o, "CANDIDATE_LIMIT", limit)
    df = spark.range(5000).select(F.col("id").alias("TransactionID"), (F.col("id") % 7).alias("TransactionDT"))
    (b,) = split.time_boundaries(df, [3210], 5000)
    assert df.filter(split.in_head(b)).count() == 3210


@pytest.mark.parametrize("heavy", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_a_heavy_value_beside_the_rank_leaves_few_values(spark, monkeypatch, heavy, kind):
    """Wanted ranks just below, at, and just above a heavy value: no task ranks many values."""
    n = 60_000
    at = int(n * 0.2)
    df = spark.range(n).select(
        F.when(F.col("id") < at, F.col("id"))
        .when(F.col("id") < at + int(n * heavy), at)
        .otherwise(F.col("id") + 1)
        .cast(kind)
        .alias("x")
    )
    held = []
    ranked = o._ranked_candidates

    def spy(frame, picks):
        out = ranked(frame, picks)
        held.extend(r["count"] for r in out.groupBy("pick").count().collect())
        return out

    monkeypatch.setattr(o, "_ranked_candidates", spy)
    values = sorted(r.x for r in df.collect())
    end = min(n, at + int(n * heavy))
    ranks = [at - 1, at, at + 5, end - 1, min(end, n - 1)]
    got = o.values_at_ranks(df, "x", ranks, n, limit=100)
    assert [g[0] for g in got] == [values[r] for r in ranks]
    assert max(held) <= 102
    held.clear()
    probs = [(at - 0.5) / (n - 1), (end - 0.5) / (n - 1) if end < n else 1.0]
    table = {r.prob: r.value for r in o.quantile_table(df, ["x"], probs, limit=100).collect()}
    for p in probs:
        assert table[p] == pytest.approx(np.quantile(values, p))
    assert max(held) <= 102


def test_all_columns_in_one_round(spark, monkeypatch):
    """387 columns take as many scans as one."""
    df = spark.range(300).select(*[((F.col("id") * (i + 7)) % 301).cast("double").alias(f"v{i}") for i in range(387)])
    jobs = []
    monkeypatch.setattr(o, "sketch_quantiles", lambda *a, f=o.sketch_quantiles: (jobs.append(1), f(*a))[1])
    got = {r.column: r.value for r in o.quantile_table(df, df.columns, [0.5]).collect()}
    assert len(got) == 387 and not jobs
    assert got["v3"] == pytest.approx(np.median([(i * 10) % 301 for i in range(300)]))


def test_history_across_cells(spark):
    """Position and gap per key equal the plain window, with one key on a third of rows."""
    rng = np.random.default_rng(3)
    rows = [(int(i), "hot" if i % 3 == 0 else f"k{rng.integers(20)}", int(t))
            for i, t in enumerate(rng.integers(0, 40 * 3600, 600))]
    df = spark.createDataFrame(rows, "id bigint, k string, s bigint")
    got = {r["id"]: (r["seq"], r["prev"]) for r in with_history(df, "k", ["s", "id"], "s").collect()}
    by_key = {}
    for i, k, s in rows:
        by_key.setdefault(k, []).append((s, i))
    for group in by_key.values():
        group.sort()
        for pos, (s, i) in enumerate(group):
            assert got[i] == (pos + 1, group[pos - 1][0] if pos else None)
