import pytest
from pyspark.sql import functions as F

from riskweave.operators import runs as R

SCHEMA = "run_name string, run_order int, auc_pr double, auc_roc double"
ROWS = [("xgb-a", 1, 0.72, 0.90), ("xgb-b", 2, 0.68, 0.88), ("lgb-c", 3, 0.79, 0.93), ("lgb-d", 4, 0.75, 0.91)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_best_run_wins(spark):
    assert R.champion(table(spark)).first()["run_name"] == "lgb-c"


def test_first_wins_a_tie(spark):
    tied = [("a", 1, 0.8, 0.9), ("b", 2, 0.8, 0.9)]
    assert R.champion(table(spark, tied)).first()["run_name"] == "a"


def test_no_runs(spark):
    with pytest.raises(R.NoRuns):
        R.require_champion(table(spark, []))


def test_comparison(spark):
    out = {r["metric"]: r for r in R.comparison_table(table(spark), ["auc_pr", "auc_roc"], ["xgb-a", "lgb-c"]).collect()}
    assert out["auc_pr"]["lgb-c"] == 0.79 and out["auc_roc"]["xgb-a"] == 0.90


def test_delta_and_meaning(spark):
    out = {r["run_name"]: (r["delta"], r["meaning"]) for r in R.ablation_delta(table(spark)).collect()}
    assert out == {"xgb-b": (-0.04, "degraded"), "lgb-c": (0.11, "improved"), "lgb-d": (-0.04, "degraded")}


def test_running_best_is_strict(spark):
    t = spark.createDataFrame([(1, i, v) for i, v in enumerate([0.2, 0.2, 0.5, 0.4])], "r int, i int, v double")
    assert [x["is_best"] for x in R.running_best(t, ["r"], "i", "v").orderBy("i").collect()] == [True, False, True, False]


def test_convergence(spark):
    t = spark.createDataFrame([("a", i, 1.0 if i == 50 else 0.1) for i in range(1, 101)]
                              + [("b", i, i / 100) for i in range(1, 101)], "run string, i int, v double")
    out = {r["run"]: (r["best_iteration"], r["converged"]) for r in R.convergence(t, "run", "i", "v").collect()}
    assert out == {"a": (50, True), "b": (100, False)}


def test_report_sentence(spark):
    m = spark.createDataFrame([(0.451718, 0.610113, 0.466078)], "threshold double, precision double, recall double")
    text = R.report_text(m).first()["report"]
    assert text.startswith("At threshold 0.4517: Precision=0.610") and "46.6% of fraud transactions caught" in text


def test_appended_metrics(spark, tmp_path):
    R.append_metrics(table(spark, ROWS[:2]), str(tmp_path / "r"))
    R.append_metrics(table(spark, ROWS[2:]), str(tmp_path / "r"))
    assert spark.read.schema(SCHEMA).json(str(tmp_path / "r")).count() == 4
