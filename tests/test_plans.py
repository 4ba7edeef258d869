"""Plan shapes that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.operators import metrics as M
from riskweave.operators import order as o
from riskweave.operators import split
from riskweave.plans import catalog
from riskweave.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(spark, sf):
    p = plan(fx.txn(spark, sf).select("TransactionAmt").filter("TransactionAmt > 5"))
    assert "ReadSchema: struct<value:double>" in p
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,5.0)]" in p


def test_unused_history_costs_nothing(spark, sf):
    p = plan(fx.txn(spark, sf).select("TransactionID", "TransactionAmt"))
    assert "Exchange" not in p and "Window" not in p


def test_splits_are_projections(spark, sf):
    df = fx.txn(spark, sf).select("TransactionID", "TransactionDT", "isFraud")
    for out in (split.temporal_split(df), split.prepare_splits(df), split.ts_folds(df)):
        p = plan(out)
        assert "Exchange" not in p and "Window" not in p and "Sort" not in p


def test_transform_broadcasts_its_state(spark, sf):
    df = fx.txn(spark, sf).drop("C13", "D1")
    p = plan(fe.FeatureEngineer().fit(df).transform(df))
    assert p.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in p and "Python" not in p


def test_ranged_curve_has_no_row_level_single_partition(spark, sf):
    """Only the table of ranges (a bounded number of rows) goes to one task."""
    curve = M.score_curve(fx.scored(spark, sf))
    p = plan(curve)
    for line in p.splitlines():
        if "Exchange SinglePartition" in line:
            below = p.splitlines()[p.splitlines().index(line) + 1 :]
            assert any(re.search(r"HashAggregate\(keys=\[_range", x) for x in below[:4])


def test_grouped_quantiles_spread_a_hot_key(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.rand(1).alias("x"))
    edges = o.range_edges(df, ["x"], 16)["x"]
    cells = o.with_ranges(df, {"x": edges}).groupBy("k", "_range_x").count()
    assert cells.agg(F.max("count")).first()[0] < 2000 / 8


PYTHON_ALLOWED = {"tree_attribution", "champion_report", "search_trials", "registry_new", "drift_baseline",
                  "stream_drift"}


@pytest.mark.parametrize("name", ["engineer_full", "risk_metrics", "pr_curve", "linear_attribution",
                                  "request_defaults", "feature_upsert", "temporal_split", "psi", "sliding_24h"])
def test_no_python_in_the_hot_path(spark, sf, name):
    p = plan(catalog.QUERIES[name](spark, sf))
    assert "Python" not in p and "InPandas" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("name", ["risk_metrics", "engineer_full", "psi", "temporal_split", "stratified_carve",
                                  "column_medians", "group_medians", "describe_by_label"])
def test_same_answer_for_any_bracket_size(spark, sf, monkeypatch, name):
    """Narrowing down to single values gives the rows of ranking a whole bracket."""
    small = sorted(catalog.QUERIES[name](spark, sf).collect(), key=str)
    monkeypatch.setattr(o, "CANDIDATE_LIMIT", 0)
    large = sorted(catalog.QUERIES[name](spark, sf).collect(), key=str)
    assert small == large


def test_names(spark):
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert not [q for q in catalog.QUERIES if q.startswith("op") or "pipeline" in q]


def test_counts_are_shuffled_once(spark, sf):
    """The per-value counts feed the range totals and the ordering from one exchange."""
    t = fx.txn(spark, sf)
    for df in (
        o.grouped_quantiles(t, ["card1"], ["TransactionAmt", "D4"], [0.5]),
        M.score_curve(fx.scored(spark, sf)),
    ):
        df.collect()
        assert "ReusedExchange" in plan(df)
