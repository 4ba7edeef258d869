"""Queries: ranking metrics, thresholds, calibration, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import decide
from riskweave.operators import metrics as M
from riskweave.operators.runs import report_text as sentence
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.sources import fixtures as fx

CURVE = """g as (select score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
    from scored group by score),
  curve as (select *, sum(pos) over w as tp, sum(neg) over w as fp,
      sum(pos) over () as n_pos, sum(neg) over () as n_neg
    from g window w as (order by score desc rows between unbounded preceding and current row)),
  f as (select *, tp / (tp + fp) as p, tp / n_pos as rc,
      2.0::double * tp / (tp + fp + n_pos) as f1 from curve),
  best as (select * from f order by f1 desc, score asc limit 1)"""
AP = "sum(pos / n_pos * p)"
AUC = "sum(neg * ((tp - pos) + pos / 2) / (cast(n_pos as double) * n_neg))"
KS = "max(abs(tp / n_pos - fp / n_neg))"


def curve(spark: SparkSession, d: str) -> DataFrame:
    return M.score_curve(fx.scored(spark, d))


@query("pr_curve", sql(f"select {r('score')} as score, {r('p')} as precision, {r('rc')} as recall from f", CURVE))
def pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.pr_curve(curve(spark, d)))


@query("avg_precision", sql(f"select {r(AP)} as auc_pr from f", CURVE))
def avg_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.average_precision(curve(spark, d)))


@query("roc_auc", sql(f"select {r(AUC)} as auc_roc from f", CURVE))
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.roc_auc(curve(spark, d)))


@query("ks_stat", sql(f"select {r(KS)} as ks_statistic from f", CURVE))
def ks_stat(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ks_statistic(curve(spark, d)))


@query("best_f1_threshold", sql(f"select {r('score')} as threshold, {r('f1')} as f1 from best", CURVE))
def best_f1_threshold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.best_threshold(curve(spark, d)))


F2 = "coalesce(5 * p * rc / nullif(4 * p + rc, 0), 0)"


@query(
    "risk_metrics",
    sql(f"""select a.auc_pr, a.auc_roc, {r('b.f1')} as f1, {r(F2)} as f2,
      {r('b.p')} as precision, {r('b.rc')} as recall, a.ks_statistic, {r('b.score')} as threshold,
      cast(7500 as bigint) as training_rows, a.test_rows, 'none' as imbalance_strategy
      from (select {r(AP)} as auc_pr, {r(AUC)} as auc_roc, {r(KS)} as ks_statistic,
        cast(sum(pos + neg) as bigint) as test_rows from f) a cross join best b""", CURVE),
)
def risk_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.risk_metrics(fx.scored(spark, d), "none", 7500))


CELLS = """c as (select
    cast(count(*) filter (where score >= 0.5 and y = 1) as double) as tp,
    cast(count(*) filter (where score >= 0.5 and y = 0) as double) as fp,
    cast(count(*) filter (where score < 0.5 and y = 1) as double) as fn,
    cast(count(*) filter (where score < 0.5 and y = 0) as double) as tn from scored)"""


@query(
    "threshold_metrics",
    sql(f"""select {r('tp / (tp + fp)')} as precision, {r('tp / (tp + fn)')} as recall,
      {r('2 * tp / (2 * tp + fp + fn)')} as f1, {r('5 * tp / (5 * tp + 4 * fn + fp)')} as f2 from c""", CELLS),
)
def threshold_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.threshold_metrics(M.confusion(fx.scored(spark, d), 0.5)))


@query(
    "class_report",
    sql(f"""with z as (select *, tn / (tn + fn) as p0, tn / (tn + fp) as r0, 2 * tn / (2 * tn + fn + fp) as f0,
        tp / (tp + fp) as p1, tp / (tp + fn) as r1, 2 * tp / (2 * tp + fp + fn) as f1,
        tn + fp as n0, tp + fn as n1, tp + fp + fn + tn as n, (tp + tn) / (tp + fp + fn + tn) as acc from c)
      select '0' as class, {r('p0')} as precision, {r('r0')} as recall, {r('f0')} as f1, cast(n0 as bigint) as support from z
      union all select '1', {r('p1')}, {r('r1')}, {r('f1')}, cast(n1 as bigint) from z
      union all select 'accuracy', {r('acc')}, {r('acc')}, {r('acc')}, cast(n as bigint) from z
      union all select 'macro avg', {r('(p0 + p1) / 2')}, {r('(r0 + r1) / 2')}, {r('(f0 + f1) / 2')}, cast(n as bigint) from z
      union all select 'weighted avg', {r('(p0 * n0 + p1 * n1) / n')}, {r('(r0 * n0 + r1 * n1) / n')},
        {r('(f0 * n0 + f1 * n1) / n')}, cast(n as bigint) from z""".replace("with z as", "select * from (with z as", 1) + ")",
        CELLS),
)
def class_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.class_report(M.confusion(fx.scored(spark, d), 0.5)))


@query(
    "reliability_curve",
    sql(f"""select cast(greatest(ceil(score * 10) - 1, 0) as bigint) as bin, {r('avg(score)')} as mean_predicted,
      {r('avg(y)')} as positive_share, count(*) as n from scored group by 1"""),
)
def reliability_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.reliability_curve(fx.scored(spark, d)))


@query("score_decide", sql(f"select TransactionID, {r('score')} as score, cast(score >= 0.451718 as int) as prediction from scored"))
def score_decide(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("score")
    return rounded(fx.scored(spark, d).select("TransactionID", s, decide(s, 0.451718).alias("prediction")))


@query(
    "report_text",
    sql(f"""select {r('score')} as threshold, {r('p')} as precision, {r('rc')} as recall,
      printf('At threshold %.4f: Precision=%.3f (of flagged transactions, %.1f%% are fraud), Recall=%.3f (%.1f%% of fraud transactions caught).',
        round(score, 6), round(p, 6), round(p, 6) * 100, round(rc, 6), round(rc, 6) * 100) as report from best""", CURVE),
)
def report_text(spark: SparkSession, d: str) -> DataFrame:
    return sentence(rounded(M.risk_metrics(fx.scored(spark, d), "none", 0)))
