"""Queries: baselines, drift, alerts, windowed rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import event_time
from riskweave.operators import drift, serving
from riskweave.operators.split import in_head, temporal_head, time_boundaries
from riskweave.plans.ingest import AS_OF
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S
from riskweave.sources.tables import append_log, read_log, trailing_window

MONITORED = ["TransactionAmt", "C13"]
EVERY = "6 hours"
MIN_ROWS = 50


def watched(spark: SparkSession, d: str) -> DataFrame:
    """Key, time and the monitored columns, stored once: the baseline takes several passes."""
    return stored(fx.txn(spark, d).select(S.KEY, S.TIME, *MONITORED), "watched")


def timed(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", event_time(F.col("TransactionDT"), fx.EPOCH_OFFSET))


def baselines(df: DataFrame) -> list[drift.Baseline]:
    return drift.fit_baselines(temporal_head(df), MONITORED)


# --- SQL: baseline state per monitored feature ------------------------------------------

PROBS = [i / 10 for i in range(11)]


def _state(f: str) -> str:
    qs = ", ".join(f"quantile_cont({f}, {p})" for p in PROBS)
    return f"""
    head_{f} as (select {f} as x from ranked where rk < round(total * 0.75) and {f} is not null),
    e_{f} as (select list_sort(list_distinct([{qs}])) as e, avg({f}) as mean from
      (select * from ranked where rk < round(total * 0.75))),
    bins_{f} as (select i, e[i] as lo, e[i + 1] as hi, i = len(e) - 1 as last from
      (select e, unnest(range(1, len(e))) as i from e_{f})),
    base_{f} as (select i, lo, hi, last, greatest(n / sum(n) over (), 1e-6) as share from
      (select i, lo, hi, last, count(x) as n from bins_{f} left join head_{f}
        on x >= lo and (x < hi or (last and x <= hi)) group by i, lo, hi, last))"""


def _psi(f: str, rows: str, key: str) -> str:
    """PSI and mean of ``rows`` (columns key, x) per key."""
    return f"""select key, sum((a - share) * ln(a / share)) as psi, any_value(mean) as current_mean from (
      select m.key, b.share, m.mean, greatest(coalesce(n, 0) / sum(coalesce(n, 0)) over (partition by m.key), 1e-6) as a
      from (select {key} as key, avg({f}) as mean from {rows} group by 1 having count({f}) > 0) m
      cross join base_{f} b
      left join (select {key} as key, i, count(*) as n from {rows} join bins_{f}
        on {f} >= lo and ({f} < hi or (last and {f} <= hi)) group by 1, 2) c on c.key = m.key and c.i = b.i)
      group by key"""


STATES = ",".join(_state(f) for f in MONITORED)
TIMED = "timed as (select t.*, make_timestamp(cast((TransactionDT - 86400 + 1704067200) * 1000000 as bigint)) as et from txn t)"
RECENT = TIMED + ", recent as (select * from timed where et >= timestamp '2024-01-24' and et <= timestamp '2024-01-31')"


@query(
    "drift_baseline",
    sql(" union all ".join(
        f"select '{f}' as feature, {r(f'avg({f})')} as mean, {r(f'stddev_pop({f})')} as std, count({f}) as n, "
        + ", ".join(f"{r(f'quantile_cont({f}, {p})')} as p{i * 10}" for i, p in enumerate(PROBS))
        + " from ranked where rk < round(total * 0.75)" for f in MONITORED)),
)
def drift_baseline(spark: SparkSession, d: str) -> DataFrame:
    table = drift.baseline_table(spark, baselines(watched(spark, d)))
    ps = [F.col("percentiles")[i].alias(f"p{i * 10}") for i in range(11)]
    return rounded(table.select("feature", "mean", "std", "n", *ps))


@query(
    "psi",
    sql(f"select {r('psi')} as psi, (select count(*) from base_TransactionAmt) as bins from p",
        STATES + ", rest as (select * from ranked where rk >= round(total * 0.75)), p as ("
        + _psi("TransactionAmt", "rest", "1") + ")"),
)
def psi(spark: SparkSession, d: str) -> DataFrame:
    """First 75 % by time against the rest."""
    df = fx.txn(spark, d)
    n = df.count()
    (b,) = time_boundaries(df, [int(n * 0.75 + 0.5)], n)
    base = drift.fit_baselines(df.filter(in_head(b)), ["TransactionAmt"])[0]
    out = drift.psi(df.filter(~in_head(b)), base)
    return rounded(out.select("psi", F.col("bins").cast("bigint").alias("bins")))


DRIFT_ROWS = " union all ".join(
    f"select '{f}' as feature_name, {r('psi')} as psi_score, psi > 0.2 as alert_fired, "
    f"{r(f'(select mean from e_{f})')} as baseline_mean, {r('current_mean')} as current_mean, 7 as window_days "
    f"from ({_psi(f, 'recent', '1')})" for f in MONITORED
)


def feature_drift_rows(spark: SparkSession, d: str) -> DataFrame:
    df = watched(spark, d)
    return drift.feature_drift(timed(df), baselines(df), AS_OF, "event_time")


@query("feature_drift", sql(DRIFT_ROWS, STATES + ", " + RECENT))
def feature_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(feature_drift_rows(spark, d))


Z = "abs(rate - 0.0351) / sqrt(0.0351 * (1 - 0.0351) / n)"
RATE_ROWS = f"""select 'fraud_rate' as feature_name, {r(Z)} as psi_score, {Z} > 2 as alert_fired,
  cast(0.0351 as double) as baseline_mean, {r('rate')} as current_mean, 7 as window_days from (
  select count(*) as n, avg(prediction) as rate from pred_log
  where "timestamp" >= timestamp '2024-01-24' and "timestamp" <= timestamp '2024-01-31') where n >= 100"""


def rate_drift_rows(spark: SparkSession, d: str) -> DataFrame:
    return drift.rate_drift(trailing_window(fx.pred_log(spark, d), AS_OF, days=7))


@query("rate_drift", sql(RATE_ROWS))
def rate_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rate_drift_rows(spark, d))


@query(
    "drift_summary",
    sql("select count(*) as checks, count(*) filter (where alert_fired) as alerts, "
        f"bool_or(alert_fired) as any_alert from ({DRIFT_ROWS} union all {RATE_ROWS})", STATES + ", " + RECENT),
)
def drift_summary(spark: SparkSession, d: str) -> DataFrame:
    return drift.drift_summary(feature_drift_rows(spark, d), rate_drift_rows(spark, d))


SIX = "time_bucket(interval '6 hours', {t}, timestamp '1970-01-01')"
LOG_ROWS = " union all ".join(
    f"select key as \"timestamp\", '{f}' as feature_name, psi as psi_score, psi > 0.2 as alert_fired, "
    f"(select mean from e_{f}) as baseline_mean, current_mean, 7 as window_days "
    f"from ({_psi(f, 'timed', SIX.format(t='et'))})" for f in MONITORED
) + f""" union all select key, 'fraud_rate', {Z}, {Z} > 2, 0.0351, rate, 7 from (
  select {SIX.format(t='"timestamp"')} as key, count(*) as n, avg(prediction) as rate from pred_log group by 1)
  where n >= {MIN_ROWS}"""
LOG_CTE = STATES + ", " + TIMED + f", dlog as ({LOG_ROWS})"
LOG_OUT = (f"cast(epoch(\"timestamp\") as bigint) as at, feature_name, {r('psi_score')} as psi_score, alert_fired, "
           f"{r('baseline_mean')} as baseline_mean, {r('current_mean')} as current_mean, window_days")


def drift_log(spark: SparkSession, d: str) -> DataFrame:
    """The stored log of the checks of every window, as the dashboard reads it."""
    df = watched(spark, d)
    rows = drift.drift_log(
        timed(df), fx.pred_log(spark, d), baselines(df), "event_time", EVERY, MIN_ROWS
    )
    path = new_folder(spark, "drift_log")
    append_log(rows, path)
    return read_log(spark, path, S.DRIFT_LOG_SCHEMA).drop("date")


def log_out(log: DataFrame) -> DataFrame:
    at = F.unix_timestamp("timestamp").alias("at")
    return rounded(log.select(at, *[c for c in log.columns if c != "timestamp"]))


@query("drift_log_scan", sql(f"select {LOG_OUT} from dlog where \"timestamp\" >= timestamp '2024-01-17' order by 1, 2", LOG_CTE))
def drift_log_scan(spark: SparkSession, d: str) -> DataFrame:
    return log_out(drift.recent_log(drift_log(spark, d), AS_OF, 14))


@query("alert_history", sql(f"select {LOG_OUT} from dlog where feature_name <> 'fraud_rate' and alert_fired", LOG_CTE))
def alert_history(spark: SparkSession, d: str) -> DataFrame:
    return log_out(drift.alert_history(drift_log(spark, d)))


@query(
    "alert_daily_max",
    sql(f"""select strftime(date_trunc('day', "timestamp"), '%Y-%m-%d') as day, feature_name,
      {r('max(psi_score)')} as max_score from dlog group by 1, 2
      having max(psi_score) > case feature_name when 'fraud_rate' then 2.0 else 0.2 end""", LOG_CTE),
)
def alert_daily_max(spark: SparkSession, d: str) -> DataFrame:
    out = drift.alert_daily_max(drift_log(spark, d), {"fraud_rate": 2.0}, 0.2)
    return rounded(out.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


# --- windows (batch twins of the streams) ---------------------------------------------------

RATES = (f"count(*) as n, {r('avg(prediction)')} as rate, {r('avg(latency_ms)')} as avg_latency_ms, "
         f"{r('max(latency_ms)')} as max_latency_ms, "
         + ", ".join(f"{r(f'quantile_disc(latency_ms, {p})')} as {n}" for p, n in serving.LATENCIES.items()))


def window_out(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "w"]
    return rounded(
        df.select(
            F.unix_timestamp("w.start").alias("start"), F.unix_timestamp("w.end").alias("stop"), *rest
        )
    )


def hops(length: int, slide: int) -> str:
    """Rows times the sliding windows they fall in."""
    return f"""(select p.*, s.start from (select *, cast(floor(epoch("timestamp")) as bigint) as es from pred_log) p,
      lateral (select unnest(range(((es // {slide}) * {slide}) - {length - slide}, ((es // {slide}) * {slide}) + 1, {slide})) as start) s)"""


@query(
    "daily_rate",
    sql(f"select start, start + 86400 as stop, {RATES} from {hops(86400, 86400)} group by start"),
)
def daily_rate(spark: SparkSession, d: str) -> DataFrame:
    return window_out(serving.windowed_rate(fx.pred_log(spark, d), "1 day"))


@query(
    "sliding_24h",
    sql(f"select start, start + 86400 as stop, {RATES} from {hops(86400, 3600)} group by start"),
)
def sliding_24h(spark: SparkSession, d: str) -> DataFrame:
    return window_out(serving.windowed_rate(fx.pred_log(spark, d), "24 hours", "1 hour"))


@query(
    "rolling_rate_drift",
    sql(f"""select start, 'fraud_rate' as feature_name, {r(Z)} as psi_score, {Z} > 2 as alert_fired,
      cast(0.0351 as double) as baseline_mean, {r('rate')} as current_mean, 7 as window_days from (
      select start, count(*) as n, avg(prediction) as rate from {hops(604800, 86400)} group by start) where n >= 100"""),
)
def rolling_rate_drift(spark: SparkSession, d: str) -> DataFrame:
    start = F.window("timestamp", "7 days", "1 day").getField("start")
    out = drift.rate_drift(fx.pred_log(spark, d), [start])
    rest = [c for c in out.columns if c != "_k0"]
    return rounded(out.select(F.unix_timestamp("_k0").alias("start"), *rest))
