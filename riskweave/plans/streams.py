"""Queries that run a stream over the event table to its end and return its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import drift
from riskweave.plans import monitoring as mon
from riskweave.plans.ingest import log_out, requests
from riskweave.plans.modelling import VERSION, Trained
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S
from riskweave.streaming import jobs


def events_stream(spark: SparkSession, d: str) -> DataFrame:
    return jobs.parquet_stream(spark, d, jobs.EVENTS_SCHEMA, "events.parquet")


@query("stream_score")
def stream_score(spark: SparkSession, d: str) -> DataFrame:
    """Requests as JSON, scored by the fitted ensemble while they stream."""
    return scored_stream(spark, d, Trained(spark, d))


def scoring(events: DataFrame, t: Trained) -> DataFrame:
    raw = requests(events).withColumn("timestamp", F.col("ts").cast("timestamp"))
    return jobs.score_requests(raw, t.engineer, t.model.score, t.features, 0.5, VERSION)


def scored_stream(spark: SparkSession, d: str, t: Trained) -> DataFrame:
    path = new_folder(spark, "stream_score")
    jobs.to_table(scoring(events_stream(spark, d), t), path)
    return spark.read.parquet(f"{path}/table")


@query(
    "stream_score_check",
    sql("select count(*) as streamed, count(*) as scored, cast(0 as bigint) as differ from events"),
)
def stream_score_check(spark: SparkSession, d: str) -> DataFrame:
    """The streaming scorer against its batch twin, row by row."""
    t = Trained(spark, d)
    a, b = scored_stream(spark, d, t), scoring(fx.table(spark, d, "events"), t)
    rows = a.select("prediction_id", F.struct("*").alias("a")).join(
        b.select("prediction_id", F.struct("*").alias("b")), "prediction_id", "full"
    )
    return rows.agg(
        F.count("a").alias("streamed"), F.count("b").alias("scored"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differ"),
    )


LOG_OUT = ("prediction_id, cast(floor(epoch(\"timestamp\")) as bigint) as at, fraud_probability, prediction, "
           f"threshold_used, {r('latency_ms')} as latency_ms, model_version")


@query("stream_pred_log", sql(f"select {LOG_OUT} from pred_log"))
def stream_pred_log(spark: SparkSession, d: str) -> DataFrame:
    """Every event arrives twice; the log holds it once."""
    path = new_folder(spark, "stream_pred_log")
    twice = events_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    jobs.log_once(fx.shape_pred_log(twice), path)
    return log_out(spark.read.parquet(f"{path}/table").drop("batch"))


# A window is emitted once the watermark (latest event minus an hour) passes its end.
CLOSED = "stop <= (select floor(epoch(max(ts)) - 3600) from events)"


def windows_to_end(spark: SparkSession, d: str, name: str, length: str, slide: str | None):
    path = new_folder(spark, name)
    log = fx.shape_pred_log(events_stream(spark, d))
    jobs.windowed_rates(log, path, length, slide)
    return mon.window_out(spark.read.parquet(f"{path}/table").drop("until"))


@query(
    "stream_daily_rate",
    sql(f"select * from (select start, start + 86400 as stop, {mon.RATES} from {mon.hops(86400, 86400)} group by start) where {CLOSED}"),
)
def stream_daily_rate(spark: SparkSession, d: str) -> DataFrame:
    return windows_to_end(spark, d, "daily", "1 day", None)


@query(
    "stream_sliding_24h",
    sql(f"select * from (select start, start + 86400 as stop, {mon.RATES} from {mon.hops(86400, 3600)} group by start) where {CLOSED}"),
)
def stream_sliding_24h(spark: SparkSession, d: str) -> DataFrame:
    return windows_to_end(spark, d, "sliding", "24 hours", "1 hour")


@query(
    "stream_rate_drift",
    sql(f"""select start, feature_name, psi_score, alert_fired, baseline_mean, current_mean, window_days from (
      select start, start + 604800 as stop, 'fraud_rate' as feature_name, {r(mon.Z)} as psi_score, {mon.Z} > 2 as alert_fired,
      cast(0.0351 as double) as baseline_mean, {r('rate')} as current_mean, 7 as window_days from (
      select start, count(*) as n, avg(prediction) as rate from {mon.hops(604800, 86400)} group by start) where n >= 100)
      where {CLOSED}"""),
)
def stream_rate_drift(spark: SparkSession, d: str) -> DataFrame:
    path = new_folder(spark, "rate_drift")
    log = fx.shape_pred_log(events_stream(spark, d))
    jobs.to_table(jobs.windowed_rate_drift(log, "7 days", "1 day"), path)
    out = spark.read.parquet(f"{path}/table")
    rest = [c for c in out.columns if c != "w"]
    return rounded(out.select(F.unix_timestamp("w.start").alias("start"), *rest))


# The last days of the arrivals of the drift stream, as days since 1970.
ARRIVALS = [19731, 19738, 19741, 19760]
WINDOWED = f"""
  days as (select cast(floor(epoch(ts) / 86400) as bigint) as day from events group by 1),
  checks as (select max(day) as last from days, (select unnest({ARRIVALS}) as bound) where day <= bound group by bound),
  watched as (select c.last as as_of, t.* from txn t join checks c
    on floor((t.TransactionDT - 86400 + 1704067200) / 86400) between c.last - 6 and c.last),
  logged as (select c.last as as_of, l.prediction from pred_log l join checks c
    on floor(epoch(l."timestamp") / 86400) between c.last - 6 and c.last)"""
STREAM_DRIFT_ROWS = " union all ".join(
    f"select key as as_of, '{f}' as feature_name, {r('psi')} as psi_score, psi > 0.2 as alert_fired, "
    f"{r(f'(select mean from e_{f})')} as baseline_mean, {r('current_mean')} as current_mean, 7 as window_days "
    f"from ({mon._psi(f, 'watched', 'as_of')})" for f in mon.MONITORED
) + f""" union all select as_of, 'fraud_rate', {r(mon.Z)}, {mon.Z} > 2, 0.0351, {r('rate')}, 7 from (
  select as_of, count(*) as n, avg(prediction) as rate from logged group by 1) where n >= 100"""


def checked_stream(spark: SparkSession, d: str) -> DataFrame:
    """The drift log of transactions and predictions that arrive in parts, against the fitted baselines."""
    path = new_folder(spark, "stream_drift")
    rows = mon.watched(spark, d)
    base = mon.baselines(rows)
    txn = rows.select(F.floor((F.col(S.TIME) + fx.EPOCH_OFFSET) / 86400).alias("day"), *mon.MONITORED)
    log = fx.pred_log(spark, d).select(F.unix_date(F.to_date("timestamp")).cast("long").alias("day"), "prediction")
    both = stored(txn.unionByName(log, allowMissingColumns=True), "arriving")
    for before, until in zip([0, *ARRIVALS], ARRIVALS):
        part = both.filter((F.col("day") > before) & (F.col("day") <= until))
        part.write.parquet(f"{path}/in/until={until}")
        # Each run starts again from the checkpoint and checks what has come since.
        source = spark.readStream.schema(both.schema).option("recursiveFileLookup", True)
        jobs.drift_checks(source.parquet(f"{path}/in"), base, path)
    return spark.read.schema(
        "feature_name string, psi_score double, alert_fired boolean, baseline_mean double, "
        "current_mean double, window_days int, as_of long, batch int"
    ).parquet(f"{path}/table").drop("batch")


@query("stream_drift", sql(STREAM_DRIFT_ROWS, mon.STATES + "," + WINDOWED))
def stream_drift(spark: SparkSession, d: str) -> DataFrame:
    """The scheduled drift check as a stream: all monitored features and the predicted rate,
    over the seven days that end with each arrival."""
    return rounded(checked_stream(spark, d))


@query(
    "stream_drift_summary",
    sql("select count(*) as checks, count(*) filter (where alert_fired) as alerts, bool_or(alert_fired) as any_alert "
        f"from ({STREAM_DRIFT_ROWS})", mon.STATES + "," + WINDOWED),
)
def stream_drift_summary(spark: SparkSession, d: str) -> DataFrame:
    log = checked_stream(spark, d)
    is_rate = F.col("feature_name") == "fraud_rate"
    return drift.drift_summary(log.filter(~is_rate), log.filter(is_rate))
