"""Exploratory aggregates: class balance, nulls, rates, quantiles, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import clip_upper, feature_family, label_text, ratio
from riskweave.operators.order import grouped_quantiles
from riskweave.operators.quality import null_shares
from riskweave.sources import schema as S


def class_distribution(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per class
    return counts.withColumn("pct", F.col("n") / total * 100)


def null_profile(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Null share and family per column, by family, most nulls first."""
    pct = ratio(F.col("nulls"), F.col("rows")) * 100
    out = null_shares(df, columns).select(
        "column", feature_family(F.col("column")).alias("family"), pct.alias("null_pct")
    )
    out = out.orderBy(F.col("family"), F.col("null_pct").desc(), F.col("column"))
    return out if top is None else out.orderBy(F.col("null_pct").desc(), "column").limit(top)


def rate_by_category(
    df: DataFrame, top_n: dict[str, int], min_rows: int = 500, label: str = S.LABEL
) -> DataFrame:
    """Label rate of the categories with enough rows, best ``top_n`` per column."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in top_n]
    )
    limit = F.create_map(*[F.lit(x) for item in top_n.items() for x in item])
    best = Window.partitionBy("column").orderBy(F.col("rate").desc(), "category")
    return (
        df.select(label, F.explode(entries).alias("e"))
        .filter(F.col("e.category").isNotNull())
        .groupBy("e.column", "e.category")
        .agg(F.avg(label).alias("rate"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_rows)
        .withColumn("pos", F.row_number().over(best))
        .filter(F.col("pos") <= F.element_at(limit, F.col("column")))
    )


def _wide(q: DataFrame, keys: list[str], names: dict[float, str]) -> DataFrame:
    return q.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()]
    )


QUARTILES = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def describe_by_label(df: DataFrame, column: str, label: str = S.LABEL) -> DataFrame:
    stats = df.groupBy(label).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    quart = _wide(grouped_quantiles(df, [label], [column], list(QUARTILES)), [label], QUARTILES)
    return stats.join(F.broadcast(quart), label, "left")  # one row per class


def box_stats(df: DataFrame, column: str, label: str = S.LABEL) -> DataFrame:
    """Quartiles, and whiskers: the outermost values within 1.5 IQR of the box."""
    quart = _wide(grouped_quantiles(df, [label], [column], list(QUARTILES)), [label], QUARTILES)
    reach = F.lit(1.5) * (F.col("p75") - F.col("p25"))
    lo, hi = F.col("p25") - reach, F.col("p75") + reach
    c = F.col(column)
    return (
        df.select(label, column)
        .join(F.broadcast(quart), label)  # one row per class
        .groupBy(label, *QUARTILES.values())
        .agg(
            F.min(F.when(c >= lo, c)).alias("whisker_low"),
            F.max(F.when(c <= hi, c)).alias("whisker_high"),
            F.count_if((c < lo) | (c > hi)).alias("outliers"),
        )
        .withColumn("label_text", label_text(F.col(label)))
    )


def amount_by_label(df: DataFrame, top: float = 5000.0, label: str = S.LABEL) -> DataFrame:
    """Mean amount and log amount per class after clipping large amounts."""
    amt = clip_upper(F.col("TransactionAmt"), top)
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(amt).alias("mean_clipped"),
        F.max(amt).alias("max_clipped"),
        F.avg(F.log1p(F.col("TransactionAmt"))).alias("mean_log"),
    )


def amount_density(
    df: DataFrame, top: float = 5000.0, bins: int = 50, label: str = S.LABEL
) -> DataFrame:
    """Normalised histogram of the clipped amount per class (area 1 per class)."""
    width = top / bins
    amt = clip_upper(F.col("TransactionAmt"), top)
    counts = (
        df.filter(amt.isNotNull())
        .groupBy(label, F.least(F.floor(amt / width), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(label))  # at most ``bins`` rows per class
    return counts.withColumn("density", F.col("n") / total / width)


def corr_with(df: DataFrame, columns: Sequence[str], focus: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations of each column with the focus columns."""
    one = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a in columns for b in focus])
    entries = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature"),
                *[F.col(f"`{a}~{b}`").alias(f"corr_{b}") for b in focus],
            )
            for a in columns
        ]
    )
    return one.select(F.inline(entries))
