"""Queries: scans, loads, the identity join, table checks, logs, feature tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import quality, serving
from riskweave.operators.features import align_features
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import TXN_COLUMNS, big, cols, r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import buckets
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S
from riskweave.sources import tables
from riskweave.sources.feature_store import FeatureStore

SCAN = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1", "card4"]
AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
MID = dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc)


# --- scans and loads -------------------------------------------------------------------


@query("scan_labelled", sql(f"select {cols(SCAN)} from txn where isFraud is not null"))
def scan_labelled(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tables.labelled(fx.txn(spark, d), SCAN))


@query(
    "scan_ordered",
    sql(f"select {cols(TXN_COLUMNS)} from txn where isFraud is not null "
        "order by TransactionDT, TransactionID"),
)
def scan_ordered(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tables.in_time_order(fx.txn(spark, d)))


EDA = ["isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card4", "card6",
       "P_emaildomain", "D1", "D4", "D10"]


@query("eda_scan", sql(f"select {cols(EDA)} from txn"))
def eda_scan(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tables.eda_scan(fx.txn(spark, d), EDA))


@query("load_csv", sql(f"select {cols(TXN_COLUMNS)} from txn"))
def load_csv(spark: SparkSession, d: str) -> DataFrame:
    """Write the transactions as CSV with a header, load them back under the schema."""
    folder = new_folder(spark, "csv")
    source = f"{folder}/transactions_csv"
    txn = fx.txn(spark, d)
    txn.write.option("header", True).option("nullValue", "").csv(source)
    declared = {f.name: f for f in S.TRANSACTION_SCHEMA}
    schema = T.StructType([declared[c] for c in txn.columns])
    return rounded(tables.load_csv(spark, source, schema, f"{folder}/transactions_raw"))


# --- join and checks --------------------------------------------------------------------

JOINED = "select t.*, i.id_01, i.id_12, i.DeviceType from txn t left join identity i using (TransactionID)"


def joined(spark: SparkSession, d: str) -> DataFrame:
    return quality.join_identity(fx.txn(spark, d), fx.identity(spark, d))


IDENTIFIED = sql(f"select {cols(TXN_COLUMNS, 't.')}, i.id_01, i.id_12, i.DeviceType "
                 "from txn t left join identity i on t.TransactionID = i.TransactionID")


@query("join_identity", IDENTIFIED)
def join_identity(spark: SparkSession, d: str) -> DataFrame:
    return rounded(joined(spark, d))


@query("join_buckets", IDENTIFIED)
def join_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The same from two tables stored in buckets by key."""
    return rounded(buckets.left_join(*buckets.store_pair(stored(fx.txn(spark, d)), fx.identity(spark, d), S.KEY)))


@query(
    "cards_by_share",
    sql(f"""select t.TransactionID, t.card6, {r('t.TransactionAmt')} as TransactionAmt, s.n_rows, {r('s.mean')} as mean_amount
      from txn t left join (select card6, count(*) as n_rows, avg(TransactionAmt) as mean from txn group by card6) s
      on t.card6 = s.card6"""),
)
def cards_by_share(spark: SparkSession, d: str) -> DataFrame:
    """A join on a key of which one value holds about half of all rows: its rows are kept apart."""
    rows = fx.txn(spark, d, history=False).select(S.KEY, "card6", "TransactionAmt")
    means = rows.groupBy("card6").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("TransactionAmt").alias("mean_amount"))
    return rounded(buckets.left_join(*buckets.store_pair(rows, means, "card6")))


@query(
    "validate_table",
    sql("select 'transactions' as table_name, count(*) as row_count, "
        f"{big(str(len(TXN_COLUMNS)))} as column_count, count(*) >= 500 as passed from txn "
        "union all select 'identity', count(*), 4, count(*) >= 100000 from identity"),
)
def validate_table(spark: SparkSession, d: str) -> DataFrame:
    return quality.validate_table(fx.txn(spark, d), "transactions", 500).unionByName(
        quality.validate_table(fx.identity(spark, d), "identity", 100_000)
    )


STATS = f"""select count(*) as total_joined,
  count(*) filter (where TransactionID is null) as null_txn_ids,
  count(*) filter (where isFraud is null) as null_labels,
  round(sum(isFraud) / count(*) * 100, 4) as fraud_rate_pct,
  count(distinct TransactionID) as unique_txn_ids from ({{rows}})"""


@query("join_integrity", sql(STATS.format(rows=JOINED)))
def join_integrity(spark: SparkSession, d: str) -> DataFrame:
    return quality.join_integrity(joined(spark, d))


CHECKS = """
select '{case}' as input, 'no_null_transaction_ids' as check_name, null_txn_ids = 0 as passed from {t}
union all select '{case}', 'no_null_labels', null_labels = 0 from {t}
union all select '{case}', 'fraud_rate_in_range', coalesce(fraud_rate_pct / 100 between 0.15 and 0.25, false) from {t}
union all select '{case}', 'unique_transaction_ids', unique_txn_ids = total_joined from {t}"""
DUP = "select l_orderkey * 100 + l_linenumber as TransactionID, cast(null as int) as isFraud from lineitem"


@query(
    "integrity_checks",
    sql(CHECKS.format(case="joined", t="s1") + " union all " + CHECKS.format(case="lineitem", t="s2"),
        f"s1 as ({STATS.format(rows=JOINED)}), s2 as ({STATS.format(rows=DUP)})"),
)
def integrity_checks(spark: SparkSession, d: str) -> DataFrame:
    """A sound table, and one whose keys collide and whose labels are missing."""
    dup = fx.dup_key(spark, d).withColumn("isFraud", F.lit(None).cast("int"))
    out = []
    for name, df in (("joined", joined(spark, d)), ("lineitem", dup)):
        checks = quality.integrity_checks(quality.join_integrity(df), 0.15, 0.25)
        out.append(checks.select(F.lit(name).alias("input"), "check_name", "passed"))
    return out[0].unionByName(out[1])


NULLS = " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (where {c} is null) as nulls, count(*) as \"rows\" from txn"
    for c in TXN_COLUMNS
)


@query(
    "null_threshold",
    sql(f"select \"column\", nulls, \"rows\", {r('nulls / \"rows\"')} as null_share from n "
        "where nulls / \"rows\" > 0.3", f"n as ({NULLS})"),
)
def null_threshold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.null_threshold(fx.txn(spark, d), TXN_COLUMNS, 0.3))


LEAK = ["TransactionID", "card1", "TransactionAmt"]


@query(
    "id_leak_check",
    sql(" union all ".join(
        f"select '{c}' as \"column\", {r(f'abs(corr({c}, rk))')} as time_corr, "
        f"{r(f'count(distinct {c}) / count({c})')} as distinct_ratio from timed" for c in LEAK),
        "timed as (select *, rank() over (order by TransactionDT) as rk from txn)"),
)
def id_leak_check(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.id_leak_check(fx.txn(spark, d), LEAK))


@query("numeric_only", sql(f"select {cols([c for c in TXN_COLUMNS if c not in ('ProductCD', 'card4', 'card6', 'P_emaildomain', 'R_emaildomain')])} from txn"))
def numeric_only(spark: SparkSession, d: str) -> DataFrame:
    df = fx.txn(spark, d)
    return rounded(df.select(*S.numeric_columns(df.schema)))


@query(
    "align_features",
    sql(f"select TransactionID, {r('V3')} as V3, cast(null as double) as dist1, {r('D1')} as D1, "
        f"cast(null as double) as C1, {r('TransactionAmt')} as TransactionAmt from txn"),
)
def align(spark: SparkSession, d: str) -> DataFrame:
    wanted = ["V3", "dist1", "D1", "C1", "TransactionAmt"]
    return rounded(align_features(fx.txn(spark, d), wanted, keep=[S.KEY]))


@query(
    "event_time",
    sql("select TransactionID, es as unix_seconds, strftime(ts, '%Y-%m-%d') as day from txn "
        "join b on b.event_id = TransactionID"),
)
def event_time(spark: SparkSession, d: str) -> DataFrame:
    from riskweave.functions.columns import event_time as at

    t = at(F.col("TransactionDT"), fx.EPOCH_OFFSET)
    return fx.txn(spark, d).select(
        "TransactionID",
        F.unix_timestamp(t).alias("unix_seconds"),
        F.date_format(F.to_date(t), "yyyy-MM-dd").alias("day"),
    )


# --- requests and logs ------------------------------------------------------------------


def _body():
    """A request per event: amount and time always, card1 null or set, D1/C1/addr1 absent or set."""
    k = F.col("k")
    return F.concat(
        F.lit('{"TransactionAmt": '), F.col("value").cast("string"),
        F.lit(', "TransactionDT": '), (F.col("es") - fx.EPOCH_OFFSET).cast("string"),
        F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(', "card1": null')).otherwise(
            F.concat(F.lit(', "card1": '), F.col("user_id").cast("string"))),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(', "D4": '), k.cast("string"))),
        F.lit(', "extra": "x"}'),
    )


def requests(events: DataFrame) -> DataFrame:
    return fx.event_rows(events).select(
        F.col("event_id").alias("TransactionID"), "ts", _body().alias("body")
    )


def _request_sql() -> str:
    given = {
        "TransactionAmt": r("value"),
        "TransactionDT": "cast(86400 + es - 1704067200 as double)",
        "card1": "case when k % 3 = 0 then 9500.0 when k % 3 = 1 then null else cast(user_id as double) end",
        "D4": "case when k % 4 = 0 then null else cast(k as double) end",
    }
    out = []
    for n, v in S.REQUEST_DEFAULTS.items():
        e = given.get(n, f"cast({'null' if v is None else v} as double)")
        out.append(f"{e} as {n}")
    return "select event_id as TransactionID, " + ", ".join(out) + " from b"


@query("request_defaults", sql(_request_sql()))
def request_defaults(spark: SparkSession, d: str) -> DataFrame:
    raw = requests(fx.table(spark, d, "events"))
    return rounded(serving.parse_requests(raw, keep=("TransactionID",)))


# Request bodies with a fault each, by key: cut off, no object, no number, odd blanks, a null.
FAULTS = [
    ("k % 7 = 0", "concat('{{\"TransactionAmt\": ', {v})", "body is no JSON object"),
    ("k % 7 = 1", "concat('[', {v}, ']')", "body is no JSON object"),
    ("k % 7 = 2", "concat('{{\"TransactionAmt\": \"abc\", \"C1\": ', {v}, '}}')", "not a number: TransactionAmt"),
    ("k % 7 = 3", "concat('{{\"D4\": {{\"x\": 1}}, \"TransactionAmt\": \"', {v}, 'x\"}}')", "not a number: TransactionAmt,D4"),
    ("k % 7 = 4", "concat(chr(10), chr(9), '{{\"TransactionAmt\": ', {v}, '}}')", None),
    ("k % 7 = 5", "concat('{{\"TransactionAmt\": null, \"C1\": ', {v}, '}}')", None),
]


def _faulty(value: str) -> str:
    whens = " ".join(f"when {c} then {b.format(v=value)}" for c, b, _ in FAULTS)
    return f"case {whens} end"


@query(
    "request_rejects",
    sql("select TransactionID, reject_reason from (select event_id as TransactionID, case "
        + " ".join(f"when {c} then '{w}'" for c, _, w in FAULTS if w)
        + " when k % 7 = 6 then 'body is no JSON object' end as reject_reason from b) where reject_reason is not null"),
)
def request_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Requests that are set aside with a reason; a missing body (every seventh key) too."""
    rows = fx.event_rows(fx.table(spark, d, "events"))
    raw = rows.select(F.col("event_id").alias("TransactionID"), F.expr(_faulty("cast(value as string)")).alias("body"))
    return serving.rejected_requests(raw, keep=("TransactionID",))


@query(
    "request_odd_bodies",
    sql(f"""select event_id as TransactionID, case when k % 7 = 4 then {r('value')} end as TransactionAmt,
      case when k % 7 = 5 then {r('value')} else {S.REQUEST_DEFAULTS['C1']} end as C1 from b where k % 7 in (4, 5)"""),
)
def request_odd_bodies(spark: SparkSession, d: str) -> DataFrame:
    """What stays: bodies after blank lines, and an explicit null that is no default."""
    rows = fx.event_rows(fx.table(spark, d, "events"))
    raw = rows.select(F.col("event_id").alias("TransactionID"), F.expr(_faulty("cast(value as string)")).alias("body"))
    return rounded(serving.parse_requests(raw, keep=("TransactionID",)).select("TransactionID", "TransactionAmt", "C1"))


LOG = ("prediction_id, cast(floor(epoch(\"timestamp\")) as bigint) as at, fraud_probability, prediction, "
       "threshold_used, round(latency_ms, 6) as latency_ms, model_version")


def log_out(df: DataFrame) -> DataFrame:
    return rounded(
        df.select(
            "prediction_id", F.unix_timestamp("timestamp").alias("at"), "fraud_probability",
            "prediction", "threshold_used", "latency_ms", "model_version",
        )
    )


@query("log_partitioned", sql(f"select {LOG} from pred_log where \"timestamp\" >= timestamp '2024-01-16'"))
def log_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Write the log by day, then read from a date on: only those days are opened."""
    path = new_folder(spark, "prediction_logs")
    tables.append_log(fx.pred_log(spark, d), path)
    return log_out(tables.read_log(spark, path, S.PREDICTION_LOG_SCHEMA, since=MID))


@query("pred_log_append", sql(f"select {LOG} from pred_log"))
def pred_log_append(spark: SparkSession, d: str) -> DataFrame:
    """Two appends, one table."""
    path = new_folder(spark, "prediction_logs")
    log = fx.pred_log(spark, d)
    for part in (F.col("prediction") == 0, F.col("prediction") == 1):
        tables.append_log(log.filter(part), path)
    return log_out(tables.read_log(spark, path, S.PREDICTION_LOG_SCHEMA))


@query("window_filter", sql(f"select {LOG} from pred_log where \"timestamp\" >= timestamp '2024-01-24' and \"timestamp\" <= timestamp '2024-01-31'"))
def window_filter(spark: SparkSession, d: str) -> DataFrame:
    return log_out(tables.trailing_window(fx.pred_log(spark, d), AS_OF, days=7))


@query(
    "serving_metrics_24h",
    sql(f"""select count(*) as total_predictions, {r('coalesce(avg(prediction), 0)')} as fraud_rate,
      {r('coalesce(avg(latency_ms), 0)')} as avg_latency_ms,
      {r('coalesce(quantile_cont(latency_ms, 0.5), 0)')} as p50_latency_ms,
      {r('coalesce(quantile_cont(latency_ms, 0.95), 0)')} as p95_latency_ms,
      {r('coalesce(quantile_cont(latency_ms, 0.99), 0)')} as p99_latency_ms
      from pred_log where "timestamp" >= timestamp '2024-01-15' and "timestamp" <= timestamp '2024-01-16'"""),
)
def serving_metrics_24h(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serving.serving_metrics(fx.pred_log(spark, d), MID))


@query("predictions_today", sql("select count(*) as predictions_today from pred_log where cast(\"timestamp\" as date) = date '2024-01-15'"))
def predictions_today(spark: SparkSession, d: str) -> DataFrame:
    return serving.predictions_on(fx.pred_log(spark, d), dt.date(2024, 1, 15))


# --- feature table ------------------------------------------------------------------------

STORED = ["TransactionAmt", "addr1", "C13", "D1", "D4", "D10"]


LATEST = sql(f"select card1, TransactionDT, TransactionID, {cols(STORED)} from ("
             "select *, row_number() over (partition by card1 order by TransactionDT desc, TransactionID desc) as rn "
             "from txn) where rn = 1")


def feature_batches(spark: SparkSession, d: str) -> list[DataFrame]:
    """Registered features of debit cards, and then of all."""
    debit = fx.txn(spark, d).filter(F.col("card6") == "debit")
    return [tables.registered_only(rows, "card1", [S.TIME, S.KEY]) for rows in (debit, fx.txn(spark, d))]


@query("feature_upsert", LATEST)
def feature_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The latest registered features per card, upserted from two batches."""
    return rounded(tables.upsert_features(*feature_batches(spark, d), "card1", [S.TIME, S.KEY]))


@query("feature_merge", LATEST)
def feature_merge(spark: SparkSession, d: str) -> DataFrame:
    """The same, merged one after another into a stored table in buckets."""
    batches = feature_batches(spark, d)
    store = FeatureStore(spark, new_folder(spark, "features"), batches[0].schema, "card1", [S.TIME, S.KEY], 16)
    for batch in batches:
        store.merge(batch)
    return rounded(store.read())


@query(
    "feature_lookup",
    sql("select TransactionID, round(TransactionAmt, 6) as TransactionAmt, D1, addr1 from txn "
        "where TransactionID in (select doc_id from labels)"),
)
def feature_lookup(spark: SparkSession, d: str) -> DataFrame:
    feats = tables.registered_only(fx.txn(spark, d), S.KEY, [S.TIME])
    store = FeatureStore(spark, new_folder(spark, "features"), feats.schema, S.KEY, [S.TIME], 16)
    store.merge(feats)
    ids = fx.table(spark, d, "labels").select(F.col("doc_id").alias(S.KEY))
    return rounded(store.lookup(ids, ["TransactionAmt", "D1", "addr1"]))


@query(
    "registry_new",
    sql("select \"column\" as feature from n where nulls < \"rows\" and \"column\" not in ("
        + ", ".join(f"'{n}'" for n, _ in S.REGISTERED_FEATURES) + ")", f"n as ({NULLS})"),
)
def registry_new(spark: SparkSession, d: str) -> DataFrame:
    df = fx.txn(spark, d)
    return tables.unregistered(quality.observed_features(df, df.columns), tables.registry(spark))
