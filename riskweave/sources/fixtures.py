"""Views that give the event table the shape of transaction data.

``txn`` and ``pred_log`` and the rest are defined in FIXTURES.md. History columns
(position and gap per card) are built from cells of a minute, so one card that holds a
third of all rows is never sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: 2024-01-01 00:00:00 UTC, the first instant of the event table.
EPOCH = 1704067200
# Seconds that turn TransactionDT back into a Unix time.
EPOCH_OFFSET = EPOCH - 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_history(df: DataFrame, key: str, order: list[str], seconds: str, cell: int = 60):
    """Add ``seq`` (1-based position per key) and ``prev`` (previous row's seconds).

    ``seconds`` must not decrease along ``order``. Rows are numbered inside
    (key, minute) cells; per-cell counts and last values carry across cells. A task orders
    the rows of one key's minute, or the cells of one key (half a million a year).
    """
    cut = df.withColumn("_cell", F.floor(F.col(seconds) / cell))
    over_cells = Window.partitionBy(key).orderBy("_cell")
    carry = (
        cut.groupBy(key, "_cell")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(seconds).alias("_last"))
        .select(
            key,
            "_cell",
            F.coalesce(
                F.sum("_n").over(over_cells.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.lag("_last").over(over_cells).alias("_carried"),
        )
    )
    inside = Window.partitionBy(key, "_cell").orderBy(*order)
    return (
        cut.withColumns(
            {"_pos": F.row_number().over(inside), "_near": F.lag(seconds).over(inside)}
        )
        .join(carry, [key, "_cell"], "left")
        .withColumns(
            {
                "seq": F.col("_before") + F.col("_pos"),
                "prev": F.coalesce(F.col("_near"), F.col("_carried")),
            }
        )
        .drop("_cell", "_pos", "_near", "_before", "_carried")
    )


def event_rows(events: DataFrame) -> DataFrame:
    """Events with the parsed key ``k`` and whole Unix seconds ``es``."""
    ntz_zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.timestamp_diff("SECOND", ntz_zero, F.col("ts").cast("timestamp_ntz")).alias("es"),
    )


def txn_columns(history: bool) -> list:
    k, eid, value = F.col("k"), F.col("event_id"), F.col("value")

    def dom(m: int):
        return F.concat(F.lit("dom"), (k % m).cast("string"))

    null_d = F.lit(None).cast("double")
    cols = [
        eid.alias("TransactionID"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("isFraud"),
        (F.col("es") - EPOCH_OFFSET).alias("TransactionDT"),
        value.alias("TransactionAmt"),
        F.substring(F.lit("WCRHS"), (k % 5 + 1).cast("int"), F.lit(1)).alias("ProductCD"),
        F.col("user_id").alias("card1"),
        F.when(k % 10 != 9, F.concat(F.lit("net"), (k % 4).cast("string"))).alias("card4"),
        F.when(k % 2 == 0, "debit").otherwise("credit").alias("card6"),
        dom(20).alias("P_emaildomain"),
        F.when(k % 3 != 0, dom(7)).alias("R_emaildomain"),
        F.when(eid % 10 != 0, (F.col("user_id") % 40 + 100).cast("double")).alias("addr1"),
    ]
    if history:
        cols += [
            F.col("seq").cast("double").alias("C13"),
            F.floor((F.col("es") - F.col("prev")) / 3600).cast("double").alias("D1"),
        ]
    return cols + [
        F.when(k % 4 != 0, k.cast("double")).alias("D4"),
        F.when(k % 5 != 0, F.floor(value).cast("double")).alias("D10"),
        F.when(eid % 2 != 0, value * 2).alias("V1"),
        null_d.alias("V2"),
        (value / 2).alias("V3"),
    ]


def txn(spark: SparkSession, sf_dir: str, history: bool = True) -> DataFrame:
    """One row per event. Without ``history`` (C13, D1) it is a plain projection."""
    return txn_of(table(spark, sf_dir, "events"), history)


def txn_of(events: DataFrame, history: bool = True) -> DataFrame:
    rows = event_rows(events)
    if history:
        rows = with_history(rows, "user_id", ["ts", "event_id"], "es")
    return rows.select(*txn_columns(history))


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = txn(spark, sf_dir, history=False).filter(F.col("TransactionID") % 4 == 0)
    return t.select(
        "TransactionID",
        F.col("card1").cast("string").alias("id_01"),
        F.when(F.col("TransactionID") % 8 == 0, "Found").otherwise("NotFound").alias("id_12"),
        F.when(F.col("card6") == "debit", "mobile").otherwise("desktop").alias("DeviceType"),
    )


def shape_pred_log(events: DataFrame) -> DataFrame:
    p = F.col("value") / (F.col("value") + 50)
    return events.select(
        F.md5(F.col("event_id").cast("string")).alias("prediction_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.round(p, 6).alias("fraud_probability"),
        F.when(p >= 0.5, 1).otherwise(0).alias("prediction"),
        F.lit(0.5).alias("threshold_used"),
        (F.col("value") * 10).alias("latency_ms"),
        F.lit("m1").alias("model_version"),
    )


def pred_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_pred_log(table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    amt = F.col("TransactionAmt")
    return txn(spark, sf_dir, history=False).select(
        "TransactionID", "TransactionDT", "ProductCD", "card6",
        F.col("isFraud").alias("y"), (amt / (amt + 50)).alias("score"),
    )


def learn(spark: SparkSession, sf_dir: str, history: bool = True) -> DataFrame:
    """``txn`` with a label that its columns can explain."""
    total = F.coalesce("TransactionAmt", F.lit(0.0)) + F.coalesce("D4", F.lit(0.0))
    return txn(spark, sf_dir, history).withColumn("isFraud", F.when(total > 160, 1).otherwise(0))


def dup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("TransactionID")
    )
