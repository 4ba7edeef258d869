"""Queries: fitted state, feature transforms, encodings, their gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.operators import features as fe
from riskweave.operators import quality
from riskweave.operators.lookup import State, lookup_join
from riskweave.operators.order import quantile_table
from riskweave.operators.split import in_head, time_boundaries
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S

IMPUTED = ["TransactionAmt", "card1", "C13", "D1", "D4", "D10", "addr1"]
V = ["V1", "V2", "V3"]
NORM = ["D1", "D4", "D10"]
TE = ["card4", "card6", "P_emaildomain", "R_emaildomain"]


def base(spark: SparkSession, d: str) -> DataFrame:
    """The transaction table, stored once: fitting reads it several times."""
    return stored(fx.txn(spark, d), "txn")


def train_boundary(df: DataFrame):
    n = df.count()
    return time_boundaries(df, [int(n * 0.75)], n)[0]


# --- SQL of the fitted state, over the first 75 % of the rows by time ---------------------

STATE = f"""
tr as (select * from ranked where rk < floor(total * 0.75)),
med as (select {', '.join(f'coalesce(median({c}), 0) as m_{c}' for c in IMPUTED + V)} from tr),
gm as (select card1, {', '.join(f'median({c}) as g_{c}' for c in NORM)} from tr group by card1),
ov as (select avg(isFraud) as overall from tr),
""" + ",\n".join(
    f"cs_{c} as (select {c}, cast(sum(isFraud) as double) as s_{c}, cast(count(*) as double) as n_{c} "
    f"from tr where {c} is not null group by {c})" for c in TE
) + f""",
imp as (
  select k.TransactionID, k.isFraud, k.TransactionDT, k.ProductCD, k.card4, k.card6,
    k.P_emaildomain, k.R_emaildomain, k.rk, k.total,
    coalesce(k.card1, cast(m_card1 as bigint)) as card1,
    {', '.join(f'coalesce(k.{c}, m_{c}) as {c}' for c in IMPUTED + V if c != 'card1')}
  from ranked k cross join med)
"""

TIME_SQL = """cast(((TransactionDT % 86400) + 86400) % 86400 as int) as time_of_day,
  cast(((TransactionDT // 86400) % 7 + 7) % 7 as int) as day_of_week,
  cast((TransactionDT % 86400) // 3600 as int) as hour_of_day"""
AMT_SQL = f"""{r('ln(1 + TransactionAmt)')} as log_transaction_amt,
  {r('coalesce(TransactionAmt / nullif(coalesce(D1, 0) + 1, 0), 0)')} as amt_to_d1_ratio,
  cast(TransactionAmt % 1 = 0 as int) as is_round_amt"""
NORM_SQL = ", ".join(f"{r(f'coalesce(i.{c} - g_{c}, 0)')} as {c}_card_norm" for c in NORM)
RAW = ["TransactionAmt", "card1", "addr1", "C13", *NORM, *V]
RAW_SQL = ", ".join(f"i.{c}" if c == "card1" else f"{r(f'i.{c}')} as {c}" for c in RAW)


def loo_sql(c: str) -> str:
    return f"case when coalesce(n_{c}, 0) > 1 then (s_{c} - isFraud) / (n_{c} - 1) else overall end"


def smooth_sql(c: str) -> str:
    w = f"(n_{c} / (n_{c} + 10))"
    return (f"case when coalesce(n_{c}, 0) > 0 then {w} * (s_{c} / n_{c}) + (1 - {w}) * overall "
            "else overall end")


JOINS = " ".join(f"left join cs_{c} on i.{c} = cs_{c}.{c}" for c in TE)


# --- state ----------------------------------------------------------------------------------


@query(
    "column_medians",
    sql(" union all ".join(
        f"select '{c}' as \"column\", {r(f'coalesce(median({c}), 0)')} as median from txn" for c in IMPUTED + V)),
)
def column_medians(spark: SparkSession, d: str) -> DataFrame:
    df = base(spark, d)
    q = quantile_table(df, IMPUTED + V, [0.5])
    return rounded(q.select("column", F.coalesce("value", F.lit(0.0)).alias("median")))


@query(
    "group_medians",
    sql("select card1, " + ", ".join(f"{r(f'median({c})')} as {c}_med" for c in NORM)
        + " from txn where card1 is not null group by card1"),
)
def group_medians(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fe.group_medians(base(spark, d), "card1", NORM).drop("n"))


@query(
    "category_stats",
    sql(" union all ".join(
        f"select '{c}' as \"column\", {c} as category, cast(sum(isFraud) as double) as label_sum, "
        f"count(*) as n from txn where {c} is not null group by {c}" for c in TE)),
)
def category_stats(spark: SparkSession, d: str) -> DataFrame:
    return fe.category_stats(fx.txn(spark, d), TE)


@query(
    "impute_median",
    sql("select i.TransactionID, " + RAW_SQL + " from imp i", STATE),
)
def impute_median(spark: SparkSession, d: str) -> DataFrame:
    df = base(spark, d)
    train = df.filter(in_head(train_boundary(df)))
    cols = ["TransactionID", *RAW]
    medians = fe.column_medians(train, IMPUTED + V)
    return rounded(fe.impute(df.select(*cols), medians))


# --- single steps ----------------------------------------------------------------------------


@query("time_features", sql(f"select TransactionID, {TIME_SQL} from txn"))
def time_features(spark: SparkSession, d: str) -> DataFrame:
    dt = F.col(S.TIME)
    return fx.txn(spark, d).select(
        S.KEY,
        C.time_of_day(dt).alias("time_of_day"),
        C.day_of_week(dt).alias("day_of_week"),
        C.hour_of_day(dt).alias("hour_of_day"),
    )


@query("amount_features", sql(f"select TransactionID, {AMT_SQL} from txn"))
def amount_features(spark: SparkSession, d: str) -> DataFrame:
    amt = F.col("TransactionAmt")
    return rounded(
        fx.txn(spark, d).select(
            S.KEY,
            C.log_amount(amt).alias("log_transaction_amt"),
            F.coalesce(C.amount_to_age(amt, F.col("D1")), F.lit(0.0)).alias("amt_to_d1_ratio"),
            C.is_round(amt).alias("is_round_amt"),
        )
    )


@query(
    "time_feature_range",
    sql("select " + ", ".join(f"{f}({c}) as {c}_{f}" for c in ("time_of_day", "day_of_week", "hour_of_day")
                              for f in ("min", "max")) + " from t",
        f"t as (select {TIME_SQL} from txn)"),
)
def time_feature_range(spark: SparkSession, d: str) -> DataFrame:
    return fe.time_feature_range(time_features(spark, d))


@query(
    "d_card_norm",
    sql(f"select i.TransactionID, {NORM_SQL} from imp i left join gm on i.card1 = gm.card1", STATE),
)
def d_card_norm(spark: SparkSession, d: str) -> DataFrame:
    return _engineered(spark, d).select(S.KEY, *[f"{c}_card_norm" for c in NORM])


def _engineered(spark: SparkSession, d: str, encoded: bool = False) -> DataFrame:
    df = base(spark, d)
    b = train_boundary(df)
    eng = fe.FeatureEngineer() if encoded else fe.without_encoding()
    eng.fit(df.filter(in_head(b)))
    return rounded(eng.transform(df, train_rows=in_head(b)))


ENGINEERED = f"""select i.TransactionID, i.isFraud, i.TransactionDT, i.ProductCD, {{more}}
  {RAW_SQL}, {TIME_SQL}, {AMT_SQL}, {NORM_SQL}{{te}}
  from imp i left join gm on i.card1 = gm.card1 {{joins}}"""
NO_TE = ENGINEERED.format(
    more="i.card4, i.card6, i.P_emaildomain, i.R_emaildomain,", te="", joins=""
)
FULL = ENGINEERED.format(
    more="",
    te=", " + ", ".join(
        f"{r(f'case when rk < floor(total * 0.75) then {loo_sql(c)} else {smooth_sql(c)} end')} as {c}_te"
        for c in TE),
    joins=JOINS + " cross join ov",
)


@query("engineer_no_te", sql(NO_TE, STATE))
def engineer_no_te(spark: SparkSession, d: str) -> DataFrame:
    return _engineered(spark, d)


@query("engineer_full", sql(FULL, STATE))
def engineer_full(spark: SparkSession, d: str) -> DataFrame:
    return _engineered(spark, d, encoded=True)


def _encoded(spark: SparkSession, d: str, loo: bool) -> DataFrame:
    df = base(spark, d)
    b = train_boundary(df)
    train = df.filter(in_head(b))
    overall = F.lit(train.agg(F.avg(S.LABEL)).first()[0] or 0.0)
    rows = train if loo else df.filter(~in_head(b))
    out = rows.select(S.KEY, S.LABEL, *TE)
    exprs = []
    for c, state in fe.category_states(train, TE).items():
        out = lookup_join(out, state, S.KEY)
        total = F.coalesce(f"{c}_sum", F.lit(0.0))
        n = F.coalesce(f"{c}_n", F.lit(0)).cast("double")
        y = F.col(S.LABEL).cast("double")
        e = fe.loo_mean(total, n, y, overall) if loo else fe.smoothed_mean(total, n, overall, S.SMOOTHING)
        exprs.append(e.alias(f"{c}_te"))
    return rounded(out.select(S.KEY, S.LABEL, *exprs))


@query(
    "loo_encode",
    sql("select i.TransactionID, " + ", ".join(f"{r(loo_sql(c))} as {c}_te" for c in TE)
        + f" from tr i {JOINS} cross join ov", STATE),
)
def loo_encode(spark: SparkSession, d: str) -> DataFrame:
    return _encoded(spark, d, loo=True).drop(S.LABEL)


@query(
    "smoothed_encode",
    sql("select i.TransactionID, " + ", ".join(f"{r(smooth_sql(c))} as {c}_te" for c in TE)
        + f" from ranked i {JOINS} cross join ov where rk >= floor(total * 0.75)", STATE),
)
def smoothed_encode(spark: SparkSession, d: str) -> DataFrame:
    return _encoded(spark, d, loo=False).drop(S.LABEL)


@query(
    "lookup_salted",
    sql(f"select TransactionID, {r('top')} as top from txn t left join "
        "(select card1 as c, max(TransactionAmt) as top from txn group by card1) on c = card1"),
)
def lookup_salted(spark: SparkSession, d: str) -> DataFrame:
    """A state table joined the way that one too large to broadcast is."""
    df = fx.txn(spark, d, history=False)
    table = df.groupBy("card1").agg(F.max("TransactionAmt").alias("top"), F.count(F.lit(1)).alias("n"))
    out = lookup_join(df.select(S.KEY, "card1"), State.of(table, "card1", "n"), S.KEY, limit=0)
    return rounded(out.select(S.KEY, "top"))


MISSABLE = ["card4", "R_emaildomain", "addr1", "D1", "D4", "D10", "V1", "V2"]


def _missing_sql() -> str:
    out = ", ".join(f"cast({c} is null as int) as {c}_was_missing" for c in ("card4", "R_emaildomain", "addr1", "D4", "D10", "V1"))
    return f"select TransactionID, {out} from txn"


@query("missing_indicators", sql(_missing_sql()))
def missing_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Columns with a training null share in (5 %, 80 %]."""
    df = base(spark, d)
    train = df.filter(in_head(train_boundary(df)))
    out = fe.missing_indicators(df.select(S.KEY, *MISSABLE), train, MISSABLE, 0.05, 0.80)
    return out.drop(*MISSABLE)


# --- audits and gates --------------------------------------------------------------------------


@query(
    "te_audit",
    sql(f"""select te, {r('avg(isFraud)')} as actual_rate, count(*) as n,
      {r('round(abs(te - avg(isFraud)), 6)')} as gap from t group by te
      order by gap desc, te limit 5""",
        STATE + f", t as (select i.isFraud, {r(smooth_sql('P_emaildomain'))} as te from ranked i {JOINS} "
        "cross join ov where rk >= floor(total * 0.75))"),
)
def te_audit(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fe.encoding_audit(_encoded(spark, d, loo=False), "P_emaildomain_te"))


TE_COLS = [f"{c}_te" for c in TE]


@query(
    "te_range_check",
    sql(" union all ".join(
        f"""select '{c}' as "column", train_min, train_max, test_min, test_max,
          test_min >= train_min - 1e-4 and test_max <= train_max + 1e-4 as in_range from (
          select min(case when head then {c} end) as train_min, max(case when head then {c} end) as train_max,
            min(case when not head then {c} end) as test_min, max(case when not head then {c} end) as test_max
          from e)""" for c in TE_COLS),
        STATE + f", e as (select f.*, k.rk < floor(k.total * 0.75) as head from ({FULL}) f "
        "join ranked k using (TransactionID))"),
)
def te_range_check(spark: SparkSession, d: str) -> DataFrame:
    df = base(spark, d)
    b = train_boundary(df)
    eng = fe.FeatureEngineer().fit(df.filter(in_head(b)))
    out = rounded(eng.transform(df, train_rows=in_head(b)))
    return rounded(fe.range_check(out, TE_COLS, in_head(b)))


NEW = ["time_of_day", "day_of_week", "hour_of_day", "log_transaction_amt", "amt_to_d1_ratio",
       "is_round_amt", *[f"{c}_card_norm" for c in NORM]]


@query(
    "null_gate",
    sql("select count(*) as \"rows\", "
        + " + ".join(f"count(*) filter (where {c} is null)" for c in NEW) + " as engineered_nulls, "
        + " + ".join(f"count(*) filter (where {c} is null)" for c in RAW) + " as passed_on_nulls from e",
        STATE + f", e as ({NO_TE})"),
)
def null_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_gate(_engineered(spark, d), NEW, RAW)


@query(
    "feature_gate",
    sql("select count(*) as \"rows\", cast(20 as bigint) as feature_count, "
        + "cast(" + " + ".join(f"count(*) filter (where {c} is null)" for c in NEW + RAW) + " as bigint) as null_cells, "
        + " + ".join(f"count(*) filter (where {c} is null)" for c in NEW + RAW) + " = 0 as passed from e",
        STATE + f", e as ({NO_TE})"),
)
def feature_gate(spark: SparkSession, d: str) -> DataFrame:
    """Feature count and nulls over every row (a row sample is optional)."""
    df = _engineered(spark, d)
    return quality.feature_gate(df, fe.feature_columns(df), 20)


@query("feature_state_roundtrip", sql(NO_TE, STATE))
def feature_state_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Fit, save, load, transform with the loaded state."""
    df = base(spark, d)
    path = new_folder(spark, "feature_state")
    fe.without_encoding().fit(df.filter(in_head(train_boundary(df)))).save(path)
    return rounded(fe.FeatureEngineer.load(spark, path).transform(df))
