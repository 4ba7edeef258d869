"""Queries: runs as tables. A run is the evaluation of one slice of the scored rows
(product x card type); its iterations are the days of the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import attribution as A
from riskweave.operators import metrics as M
from riskweave.operators import quality
from riskweave.operators import runs as R
from riskweave.operators.features import column_medians, impute
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S

# The slices.
RUNS = [f"{p}_{c}" for p in "CHRSW" for c in ("credit", "debit")]
ORDER = {name: i + 1 for i, name in enumerate(RUNS)}


def slices(spark: SparkSession, d: str) -> DataFrame:
    day = F.floor((F.col("TransactionDT") - 86400) / 86400) + 1
    return fx.scored(spark, d).select(
        F.concat_ws("_", "ProductCD", "card6").alias("run_name"),
        day.cast("int").alias("iteration"),
        "y",
        "score",
        "TransactionDT",
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    order = F.create_map(*[F.lit(x) for item in ORDER.items() for x in item])
    out = M.risk_metrics(slices(spark, d), "none", 0, keys=["run_name"])
    return rounded(out).select(
        "run_name",
        F.element_at(order, F.col("run_name")).alias("run_order"),
        "auc_pr", "auc_roc", "f1", "ks_statistic", "test_rows",
    )


def learning_curve(spark: SparkSession, d: str) -> DataFrame:
    """Average precision per run and day."""
    keys = ["run_name", "iteration"]
    curve = M.score_curve(slices(spark, d), keys=keys)
    return rounded(M.average_precision(curve, keys))


def keyed(keys: str, name: str) -> str:
    return f"""g_{name} as (select {keys}, score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
      from sl group by {keys}, score),
    f_{name} as (select *, tp / (tp + fp) as p, coalesce(tp / nullif(n_pos, 0), 0) as rc,
        2.0::double * tp / (tp + fp + n_pos) as f1 from (
      select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over (partition by {keys}) as n_pos,
        sum(neg) over (partition by {keys}) as n_neg from g_{name}
      window w as (partition by {keys} order by score desc rows between unbounded preceding and current row)))"""


CASES = "case run_name " + " ".join(f"when '{n}' then {i}" for n, i in ORDER.items()) + " end"
SL = """sl as (select concat(ProductCD, '_', card6) as run_name,
    cast((TransactionDT - 86400) // 86400 + 1 as int) as iteration, y, score, TransactionDT from scored)"""
RUNS_CTE = SL + ", " + keyed("run_name", "run") + f""",
  runs as (select run_name, {CASES} as run_order, {r('sum(coalesce(pos / nullif(n_pos, 0), 0) * p)')} as auc_pr,
    {r('sum(coalesce(neg * ((tp - pos) + pos / 2) / nullif(cast(n_pos as double) * n_neg, 0), 0))')} as auc_roc,
    {r('max(f1)')} as f1, {r('max(abs(rc - coalesce(fp / nullif(n_neg, 0), 0)))')} as ks_statistic,
    cast(sum(pos + neg) as bigint) as test_rows from f_run group by run_name)"""
CURVE_CTE = SL + ", " + keyed("run_name, iteration", "it") + f""",
  lc as (select run_name, iteration, {r('sum(coalesce(pos / nullif(n_pos, 0), 0) * p)')} as auc_pr
    from f_it group by run_name, iteration)"""
RUN_COLS = "run_name, run_order, auc_pr, auc_roc, f1, ks_statistic, test_rows"


@query("runs_table", sql(f"select {RUN_COLS} from runs", RUNS_CTE))
def runs_table(spark: SparkSession, d: str) -> DataFrame:
    """Append the metric rows as JSON lines, read the table back."""
    path = new_folder(spark, "runs")
    out = runs(spark, d)
    R.append_metrics(out, path)
    return spark.read.schema(out.schema).json(path)


METRICS = ["auc_pr", "auc_roc", "f1"]


@query(
    "runs_pivot",
    sql("""select run_name, auc_pr, auc_roc, f1, cast(n as double) as param_rows, cast(first_dt as double) as param_first_dt
      from runs join (select run_name, count(*) as n, min(TransactionDT) as first_dt from sl group by run_name)
      using (run_name)""", RUNS_CTE),
)
def runs_pivot(spark: SparkSession, d: str) -> DataFrame:
    long = runs(spark, d).unpivot("run_name", METRICS, "name", "value")
    params = (
        slices(spark, d)
        .groupBy("run_name")
        .agg(
            F.count(F.lit(1)).cast("double").alias("rows"),
            F.min("TransactionDT").cast("double").alias("first_dt"),
        )
        .unpivot("run_name", ["rows", "first_dt"], "name", "value")
    )
    return R.runs_pivot(long, params, METRICS, ["rows", "first_dt"])


@query("champion", sql(f"select {RUN_COLS} from runs order by auc_pr desc, run_order limit 1", RUNS_CTE))
def champion(spark: SparkSession, d: str) -> DataFrame:
    return R.champion(runs(spark, d))


@query(
    "comparison_table",
    sql(" union all ".join(
        f"select '{m}' as metric, " + ", ".join(f"max(case when run_name = '{n}' then {m} end) as {n}" for n in RUNS)
        + " from runs" for m in METRICS), RUNS_CTE),
)
def comparison_table(spark: SparkSession, d: str) -> DataFrame:
    return R.comparison_table(runs(spark, d), METRICS, RUNS)


@query(
    "running_best",
    sql("""select *, best_before is null or auc_pr > best_before as is_best from (
      select *, max(auc_pr) over (partition by run_name order by iteration
        rows between unbounded preceding and 1 preceding) as best_before from lc)""", CURVE_CTE),
)
def running_best(spark: SparkSession, d: str) -> DataFrame:
    return R.running_best(learning_curve(spark, d), ["run_name"], "iteration", "auc_pr")


@query(
    "convergence",
    sql("""select run_name, best_iteration, iterations, best_iteration < iterations * 0.95 as converged from (
      select run_name, arg_max(iteration, auc_pr * 1000000 - iteration / 1000) as best_iteration,
        max(iteration) as iterations from lc group by run_name)""", CURVE_CTE),
)
def convergence(spark: SparkSession, d: str) -> DataFrame:
    return R.convergence(learning_curve(spark, d), "run_name", "iteration", "auc_pr")


@query(
    "ablation_delta",
    sql(f"""select *, case when delta > 0.02 then 'improved' when delta < -0.02 then 'degraded' else 'unchanged' end as meaning
      from (select a.*, b.run_name as previous_run, {r('a.auc_pr - b.auc_pr')} as delta
        from runs a join runs b on a.run_order = b.run_order + 1)""", RUNS_CTE),
)
def ablation_delta(spark: SparkSession, d: str) -> DataFrame:
    return R.ablation_delta(runs(spark, d))


@query(
    "model_gate",
    sql("select run_name, auc_pr, auc_pr >= 0.48 as passed from runs order by run_order desc limit 1", RUNS_CTE),
)
def model_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.model_gate(runs(spark, d), 0.48)


# --- attributions of a linear model --------------------------------------------------------

EXPLAINED = ["TransactionAmt", "D4", "D10", "addr1", "V1", "C13"]


def _explained(spark: SparkSession, d: str):
    """Imputed rows, and per feature the marginal slope of the label and the mean."""
    df = fx.txn(spark, d).select(S.KEY, S.LABEL, *EXPLAINED)
    df = stored(df, "explained")
    df = impute(df, column_medians(df, EXPLAINED))
    return df, A.marginal_slopes(df, EXPLAINED, S.LABEL)


ATTR_CTE = f"""m as (select {', '.join(f'coalesce(median({c}), 0) as m_{c}' for c in EXPLAINED)} from txn),
  x as (select TransactionID, isFraud, {', '.join(f'coalesce({c}, m_{c}) as {c}' for c in EXPLAINED)} from txn cross join m),
  co as (select {', '.join(f'regr_slope(isFraud, {c}) as b_{c}, avg({c}) as a_{c}' for c in EXPLAINED)} from x),
  attr as (""" + " union all ".join(
    f"select TransactionID, '{c}' as feature, ({c} - a_{c}) * b_{c} as v from x cross join co" for c in EXPLAINED
) + ")"


@query("linear_attribution", sql(f"select TransactionID, feature, {r('v')} as value from attr", ATTR_CTE))
def linear_attribution(spark: SparkSession, d: str) -> DataFrame:
    df, model = _explained(spark, d)
    return rounded(A.linear_attribution(df, S.KEY, model))


@query("attribution_importance", sql(f"select feature, {r('avg(abs(v))')} as importance from attr group by feature", ATTR_CTE))
def attribution_importance(spark: SparkSession, d: str) -> DataFrame:
    df, model = _explained(spark, d)
    return rounded(A.importance(A.linear_attribution(df, S.KEY, model)))


@query(
    "importance_rank",
    sql(f"""select feature, {r('importance')} as importance, cast(rk as int) as rank from (
      select *, row_number() over (order by importance desc, feature) as rk from (
        select feature, avg(abs(v)) as importance from attr group by feature)) where rk <= 20""", ATTR_CTE),
)
def importance_rank(spark: SparkSession, d: str) -> DataFrame:
    df, model = _explained(spark, d)
    return rounded(A.ranked_importance(A.linear_attribution(df, S.KEY, model), top=20))


@query(
    "topk_attribution",
    sql(f"""select TransactionID, cast(rk as int) as rank, feature, value,
      case when value > 0 then 'increases_fraud_risk' else 'decreases_fraud_risk' end as direction from (
      select *, row_number() over (partition by TransactionID order by abs(value) desc, feature) as rk
      from (select TransactionID, feature, {r('v')} as value from attr)) where rk <= 3""", ATTR_CTE),
)
def topk_attribution(spark: SparkSession, d: str) -> DataFrame:
    df, model = _explained(spark, d)
    return A.top_attributions(df, S.KEY, model)


@query("importance_csv", sql(f"select feature, {r('avg(abs(v))')} as importance from attr group by feature", ATTR_CTE))
def importance_csv(spark: SparkSession, d: str) -> DataFrame:
    """Write the importance table as CSV with a header, read it back."""
    path = new_folder(spark, "importance")
    df, model = _explained(spark, d)
    out = rounded(A.importance(A.linear_attribution(df, S.KEY, model)))
    out.coalesce(1).write.option("header", True).csv(path)
    return spark.read.schema(out.schema).option("header", True).csv(path)
