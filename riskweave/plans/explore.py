"""Queries: exploratory profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import profile
from riskweave.operators.split import class_balance
from riskweave.operators.imbalance import balanced_weights
from riskweave.plans.ingest import NULLS
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import TXN_COLUMNS, r, sql
from riskweave.functions.columns import risk_band as band
from riskweave.sources import fixtures as fx


@query(
    "class_distribution",
    sql(f"select isFraud, count(*) as n, {r('count(*) * 100.0 / sum(count(*)) over ()')} as pct "
        "from txn group by isFraud"),
)
def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.class_distribution(fx.txn(spark, d)))


@query(
    "class_weights",
    sql(f"""select count(*) filter (where isFraud = 0) as n_negative,
      count(*) filter (where isFraud = 1) as n_positive,
      {r('count(*) filter (where isFraud = 0) / count(*) filter (where isFraud = 1)')} as scale_pos_weight,
      {r('avg(isFraud)')} as fraud_rate from txn"""),
)
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    return rounded(class_balance(fx.txn(spark, d)))


@query(
    "balanced_weights",
    sql(f"select isFraud, count(*) as n, {r('sum(count(*)) over () / (2 * count(*))')} as weight "
        "from txn group by isFraud"),
)
def balanced(spark: SparkSession, d: str) -> DataFrame:
    return rounded(balanced_weights(fx.txn(spark, d)))


FAMILY = """case when "column" like 'V%' then 'V' when "column" like 'C%' then 'C'
  when "column" like 'D%' then 'D' when "column" like 'M%' then 'M'
  when starts_with("column", 'id_') then 'id_' when "column" like 'card%' then 'card'
  when "column" like 'addr%' then 'addr' else 'other' end"""


@query(
    "null_profile",
    sql(f"select \"column\", {FAMILY} as family, {r('nulls * 100.0 / \"rows\"')} as null_pct from n "
        "order by family, null_pct desc, \"column\"", f"n as ({NULLS})"),
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.null_profile(fx.txn(spark, d), TXN_COLUMNS))


TOP = {"card4": 10, "card6": 8, "P_emaildomain": 12}


@query(
    "rate_by_category",
    sql(f"""select "column", category, {r('rate')} as rate, n, pos from (
      select *, row_number() over (partition by "column" order by rate desc, category) as pos from (
        {' union all '.join(f"select '{c}' as \"column\", {c} as category, avg(isFraud) as rate, count(*) as n from txn where {c} is not null group by {c} having count(*) >= 500" for c in TOP)}
      )) where pos <= case "column" when 'card4' then 10 when 'card6' then 8 else 12 end"""),
)
def rate_by_category(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.rate_by_category(fx.txn(spark, d), TOP))


@query(
    "describe_by_label",
    sql(f"""select isFraud, count(TransactionAmt) as n, {r('avg(TransactionAmt)')} as mean,
      {r('stddev_samp(TransactionAmt)')} as std, {r('min(TransactionAmt)')} as "min",
      {r('max(TransactionAmt)')} as "max", {r('quantile_cont(TransactionAmt, 0.25)')} as p25,
      {r('quantile_cont(TransactionAmt, 0.5)')} as p50, {r('quantile_cont(TransactionAmt, 0.75)')} as p75
      from txn group by isFraud"""),
)
def describe_by_label(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.describe_by_label(fx.txn(spark, d), "TransactionAmt"))


@query(
    "box_stats",
    sql(f"""select isFraud, {r('p25')} as p25, {r('p50')} as p50, {r('p75')} as p75,
      {r('min(case when x >= p25 - 1.5 * (p75 - p25) then x end)')} as whisker_low,
      {r('max(case when x <= p75 + 1.5 * (p75 - p25) then x end)')} as whisker_high,
      count(*) filter (where x < p25 - 1.5 * (p75 - p25) or x > p75 + 1.5 * (p75 - p25)) as outliers,
      case when isFraud = 1 then 'Fraud' else 'Legitimate' end as label_text
      from x join q using (isFraud) group by isFraud, p25, p50, p75""",
        """x as (select isFraud, ln(1 + TransactionAmt) as x from txn),
      q as (select isFraud, quantile_cont(x, 0.25) as p25, quantile_cont(x, 0.5) as p50,
        quantile_cont(x, 0.75) as p75 from x group by isFraud)"""),
)
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    df = fx.txn(spark, d).select("isFraud", F.log1p("TransactionAmt").alias("log_amt"))
    return rounded(profile.box_stats(df, "log_amt"))


@query(
    "amount_by_label",
    sql(f"""select isFraud, count(*) as n,
      {r('avg(case when TransactionAmt > 200 then 200.0 else TransactionAmt end)')} as mean_clipped,
      {r('max(case when TransactionAmt > 200 then 200.0 else TransactionAmt end)')} as max_clipped,
      {r('avg(ln(1 + TransactionAmt))')} as mean_log from txn group by isFraud"""),
)
def amount_by_label(spark: SparkSession, d: str) -> DataFrame:
    """Clipped at 200 here: the data has no amount above the usual 5000."""
    return rounded(profile.amount_by_label(fx.txn(spark, d), top=200.0))


@query(
    "amount_density",
    sql(f"""select isFraud, bin, count(*) as n,
      {r('count(*) / sum(count(*)) over (partition by isFraud) / 4.0')} as density from (
      select isFraud, cast(least(floor(least(TransactionAmt, 200.0) / 4.0), 49) as bigint) as bin
      from txn where TransactionAmt is not null) group by isFraud, bin"""),
)
def amount_density(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.amount_density(fx.txn(spark, d), top=200.0, bins=50))


CORR = ["D1", "D4", "D10"]
FOCUS = ["isFraud", "TransactionAmt", "TransactionDT"]


@query(
    "corr_with_label",
    sql(" union all ".join(
        f"select '{a}' as feature, " + ", ".join(f"{r(f'corr({a}, {b})')} as corr_{b}" for b in FOCUS)
        + " from txn" for a in CORR)),
)
def corr_with_label(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(profile.corr_with(fx.txn(spark, d), CORR, FOCUS))
    return out.orderBy(F.abs("corr_isFraud").desc(), "feature")


@query(
    "risk_band",
    sql("select TransactionID, case when score >= 0.5 then 'high' when score >= 0.25 then 'medium' "
        "else 'low' end as band from scored"),
)
def risk_band(spark: SparkSession, d: str) -> DataFrame:
    return fx.scored(spark, d).select("TransactionID", band(F.col("score")).alias("band"))
