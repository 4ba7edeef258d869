"""Checks on tables: sizes, join integrity, null shares, gates, leak detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import ratio
from riskweave.operators.order import running_totals
from riskweave.sources import schema as S


class Violation(ValueError):
    """Raised by a strict check; carries the names of the failed checks."""

    def __init__(self, failed: list[str]):
        super().__init__("failed checks: " + ", ".join(failed))
        self.failed = failed


def join_identity(txn: DataFrame, identity: DataFrame) -> DataFrame:
    """Every transaction, with its identity columns where there are any."""
    return txn.join(identity, S.KEY, "left")


def validate_table(df: DataFrame, label: str, min_rows: int, strict: bool = False) -> DataFrame:
    out = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(label).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        (F.col("row_count") >= min_rows).alias("passed"),
    )
    if strict and not out.first()["passed"]:
        raise Violation([f"{label}: row_count"])
    return out


def join_integrity(joined: DataFrame, approx: bool = False) -> DataFrame:
    """Totals of the joined table in one pass; ``approx`` estimates the distinct keys."""
    distinct = F.approx_count_distinct(S.KEY) if approx else F.count_distinct(S.KEY)
    return joined.agg(
        F.count(F.lit(1)).alias("total_joined"),
        F.count_if(F.col(S.KEY).isNull()).alias("null_txn_ids"),
        F.count_if(F.col(S.LABEL).isNull()).alias("null_labels"),
        F.round(F.sum(F.col(S.LABEL)) / F.count(F.lit(1)) * 100, 4).alias("fraud_rate_pct"),
        distinct.alias("unique_txn_ids"),
    )


def integrity_checks(stats: DataFrame, rate_min: float, rate_max: float) -> DataFrame:
    """The four checks as rows (check, passed)."""
    rate = F.col("fraud_rate_pct") / 100
    checks = {
        "no_null_transaction_ids": F.col("null_txn_ids") == 0,
        "no_null_labels": F.col("null_labels") == 0,
        "fraud_rate_in_range": rate.between(rate_min, rate_max),
        "unique_transaction_ids": F.col("unique_txn_ids") == F.col("total_joined"),
    }
    rows = [
        F.struct(F.lit(n).alias("check_name"), F.coalesce(c, F.lit(False)).alias("passed"))
        for n, c in checks.items()
    ]
    return stats.select(F.inline(F.array(*rows)))


def require(checks: DataFrame) -> None:
    failed = [r["check_name"] for r in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise Violation(failed)


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, rows): one pass over the table, then one row per column."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]
    return one.select(F.inline(F.array(*entries)), F.col("_rows").alias("rows")).select(
        "column", "nulls", "rows"
    )


def null_threshold(df: DataFrame, columns: Sequence[str], max_share: float) -> DataFrame:
    """Columns whose null share exceeds the allowed one."""
    share = ratio(F.col("nulls"), F.col("rows"))
    return null_shares(df, columns).withColumn("null_share", share).filter(
        F.col("null_share") > max_share
    )


def null_gate(df: DataFrame, engineered: Sequence[str], passed_on: Sequence[str]) -> DataFrame:
    """Null cells left in the engineered and in the passed-on columns."""

    def nulls(cols):
        if not cols:
            return F.lit(0).cast("bigint")
        per_row = F.size(F.array_compact(F.array(*[F.when(F.col(c).isNull(), 1) for c in cols])))
        return F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        nulls(engineered).alias("engineered_nulls"),
        nulls(passed_on).alias("passed_on_nulls"),
    )


def feature_gate(
    df: DataFrame, features: Sequence[str], expected: int, sample_rows: int | None = None
) -> DataFrame:
    """Feature count equals ``expected`` and no null cell, on all or the first rows by key."""
    rows = df if sample_rows is None else df.orderBy(S.KEY).limit(sample_rows)
    count = F.lit(len(features)).cast("bigint")
    return null_gate(rows, features, []).select(
        "rows",
        count.alias("feature_count"),
        F.col("engineered_nulls").alias("null_cells"),
        ((count == expected) & (F.col("engineered_nulls") == 0)).alias("passed"),
    )


def id_leak_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: share of distinct values, and |correlation| with the time rank.

    A column that is nearly unique and follows time tells a model which side of the
    split a row is on. Rows are summed per time value; only those sums are ranked.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_n")).first()
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}

    def centre(c: str) -> Column:
        # Whole numbers are centred before they become doubles, which keeps large ids apart.
        at = means[c] or 0.0
        if c in whole:
            return (F.col(c).cast("decimal(20,0)") - F.lit(int(at)).cast("decimal(20,0)")).cast("double")
        return F.col(c).cast("double") - F.lit(float(at))

    centred = {c: centre(c) for c in columns}
    per_time = df.groupBy(S.TIME).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x).alias(f"s_{c}") for c, x in centred.items()],
        *[F.sum(x * x).alias(f"q_{c}") for c, x in centred.items()],
    )
    rank = F.col("cum_n") - F.col("n") + 1 - F.lit((means["_n"] + 1) / 2)
    ranked = running_totals(per_time, S.TIME, ["n"]).withColumn("r", rank)
    n = F.sum("n")
    r1, r2 = F.sum(F.col("n") * F.col("r")), F.sum(F.col("n") * F.col("r") * F.col("r"))
    corr = ranked.agg(
        *[
            F.abs(
                F.try_divide(
                    F.sum(F.col("r") * F.col(f"s_{c}")) - r1 * F.sum(f"s_{c}") / n,
                    F.sqrt(r2 - r1 * r1 / n)
                    * F.sqrt(F.sum(f"q_{c}") - F.sum(f"s_{c}") * F.sum(f"s_{c}") / n),
                )
            ).alias(c)
            for c in columns
        ]
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("time_corr")) for c in columns]
    )
    values = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    distinct = (
        df.select(F.explode(values).alias("e"))
        .filter(F.col("e.v").isNotNull())
        .groupBy("e.column", "e.v")
        .agg(F.count(F.lit(1)).alias("w"))
        .groupBy("column")
        .agg(ratio(F.count(F.lit(1)), F.sum("w")).alias("distinct_ratio"))
    )
    return corr.select(F.inline(entries)).join(F.broadcast(distinct), "column")


def model_gate(runs: DataFrame, minimum: float) -> DataFrame:
    """Latest run against the minimum; no run at all fails the gate."""
    latest = runs.agg(
        F.max_by("run_name", "run_order").alias("run_name"),
        F.max_by("auc_pr", "run_order").alias("auc_pr"),
    )
    return latest.withColumn("passed", F.coalesce(F.col("auc_pr") >= minimum, F.lit(False)))


def observed_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Names of columns that hold at least one value."""
    return (
        null_shares(df, columns)
        .filter(F.col("nulls") < F.col("rows"))
        .select(F.col("column").alias("feature"))
    )


def sorted_rank(df: DataFrame, by: list, name: str = "rank") -> DataFrame:
    """1-based rank of a small report table (one row per feature or run)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*by)))
