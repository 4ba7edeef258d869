"""Queries: temporal and stratified splits, folds, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import split
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.sources import fixtures as fx

SEED = 42
DIGEST = f"md5(concat(cast(TransactionID as string), '|{SEED}'))"
SPLIT3 = """case when rk < floor(floor(total * 0.75) * 0.8) then 'train'
  when rk < floor(total * 0.75) then 'val' else 'test' end"""


def ids(df: DataFrame, *more: str) -> DataFrame:
    return df.select("TransactionID", "isFraud", *more)


@query("temporal_head", sql("select TransactionID, TransactionDT from ranked where rk < round(total * 0.75)"))
def temporal_head(spark: SparkSession, d: str) -> DataFrame:
    return split.temporal_head(fx.txn(spark, d)).select("TransactionID", "TransactionDT")


@query("temporal_split", sql(f"select TransactionID, isFraud, {SPLIT3} as split from ranked"))
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.temporal_split(fx.txn(spark, d)), "split")


CARVED = f"""carved as (
  select *, row_number() over (partition by isFraud order by {DIGEST}) as pos,
         count(*) over (partition by isFraud) as n_class from {{rows}})"""


@query(
    "stratified_carve",
    sql("select TransactionID, isFraud, pos <= ceil(n_class * 0.2) as is_val from carved",
        CARVED.format(rows="txn")),
)
def stratified_carve(spark: SparkSession, d: str) -> DataFrame:
    df = fx.txn(spark, d)
    return ids(df.withColumn("is_val", split.stratified_carve(df, 0.2, SEED)), "is_val")


PREPARED = f"""select r.*, case when r.rk >= floor(r.total * 0.75) then 'test'
    when c.pos <= ceil(c.n_class * 0.2) then 'val' else 'train' end as split
  from ranked r left join carved c using (TransactionID)"""
PREPARED_CTE = (
    "pool as (select * from ranked where rk < floor(total * 0.75)), "
    + CARVED.format(rows="pool")
    + f", prepared as ({PREPARED})"
)


@query("prepare_splits", sql("select TransactionID, isFraud, split from prepared", PREPARED_CTE))
def prepare_splits(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.prepare_splits(fx.txn(spark, d), seed=SEED), "split")


GAPPY = """gappy as (select *, row_number() over (order by t nulls first, TransactionID) - 1 as rk, count(*) over () as total
  from (select * exclude (TransactionDT), case when TransactionID % 10 < 4 then null else TransactionDT end as t from txn))"""


def gappy(spark: SparkSession, d: str) -> DataFrame:
    """Transactions of which four in ten have no time."""
    missing = F.when(F.col("TransactionID") % 10 >= 4, F.col("TransactionDT"))
    return fx.txn(spark, d).withColumn("TransactionDT", missing)


@query("temporal_split_gappy", sql(f"select TransactionID, isFraud, {SPLIT3} as split from gappy", GAPPY))
def temporal_split_gappy(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.temporal_split(gappy(spark, d)), "split")


@query("temporal_head_gappy", sql("select TransactionID from gappy where rk < round(total * 0.25)", GAPPY))
def temporal_head_gappy(spark: SparkSession, d: str) -> DataFrame:
    """A head that ends among the rows without a time."""
    return split.temporal_head(gappy(spark, d), 0.25).select("TransactionID")


@query(
    "split_summary",
    sql(f"select split, count(*) as \"rows\", {r('avg(isFraud)')} as label_rate from prepared group by split",
        PREPARED_CTE),
)
def split_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(split.split_summary(split.prepare_splits(fx.txn(spark, d), seed=SEED)))


@query(
    "split_disjoint",
    sql(f"""select cast(sum(n) as bigint) as split_rows,
      count(*) filter (where lo <> hi) as keys_in_two_splits,
      (select count(*) from txn) as source_rows from (
      select TransactionID, count(*) as n, min({SPLIT3}) as lo, max({SPLIT3}) as hi
      from ranked group by TransactionID)"""),
)
def split_disjoint(spark: SparkSession, d: str) -> DataFrame:
    df = fx.txn(spark, d)
    return split.split_check(split.temporal_split(df), df)


@query(
    "ts_folds",
    sql("select TransactionID, isFraud, cast(greatest(0, 5 - floor((total - 1 - rk) / (total // 6))) as int) as block from ranked"),
)
def ts_folds(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.ts_folds(fx.txn(spark, d), 5), "block")


@query(
    "sample_n",
    sql(f"select TransactionID, isFraud from (select *, row_number() over (order by {DIGEST}) as pos from txn) "
        "where pos <= 5000"),
)
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.sample_n(fx.txn(spark, d), 5000, SEED))


@query(
    "sample_frac",
    sql(f"select TransactionID, isFraud from txn where cast('0x' || substring({DIGEST}, 1, 15) as bigint) "
        f"< {int(0.1 * (1 << 60))}"),
)
def sample_frac(spark: SparkSession, d: str) -> DataFrame:
    return ids(split.sample_share(fx.txn(spark, d), 0.1, SEED))
