"""Exact ranking metrics from one curve: a row per distinct score, counts from above.

Rows are aggregated per score first; the running counts come from value ranges
(``order.running_totals``), so a billion distinct scores need no one-task sort.
All metrics are plain aggregates over the curve, optionally per ``keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import ratio
from riskweave.operators.order import range_edges, running_totals


def score_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "y",
    keys: Sequence[str] = (),
    n_ranges: int | None = None,
) -> DataFrame:
    """(keys, score, pos, neg, tp, fp, n_pos, n_neg), counting scores >= score.

    Rows without a score, label or key drop out.
    """
    y = F.col(label).cast("bigint")
    rows = df.select(*keys, score, label)
    for c in rows.columns:
        rows = rows.filter(F.col(c).isNotNull())
    counted = rows.select(*keys, score, y.alias("pos"), (F.lit(1) - y).alias("neg"))
    return counted_curve(counted, score, keys, n_ranges)


def counted_curve(
    rows: DataFrame, score: str = "score", keys: Sequence[str] = (), n_ranges: int | None = None
) -> DataFrame:
    """The curve of rows that stand for ``pos`` positive and ``neg`` negative ones."""
    edges = range_edges(rows, [score], n_ranges)[score]
    per_score = rows.groupBy(*keys, score).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    out = running_totals(per_score, score, ["pos", "neg"], keys, descending=True, edges=edges)
    return out.select(
        *keys,
        F.col(score).alias("score"),
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("total_pos").alias("n_pos"),
        F.col("total_neg").alias("n_neg"),
    )


def precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio(F.col("tp"), F.col("n_pos"))


def f1_score() -> Column:
    return ratio(F.col("tp") * 2, F.col("tp") + F.col("fp") + F.col("n_pos"))


def pr_curve(curve: DataFrame) -> DataFrame:
    return curve.select("score", precision().alias("precision"), recall().alias("recall"))


def _average_precision() -> Column:
    return F.sum(ratio(F.col("pos"), F.col("n_pos")) * precision())


def _roc_auc() -> Column:
    before = F.col("tp") - F.col("pos")
    area = F.col("neg") * (before + F.col("pos") / 2)
    return F.sum(ratio(area, F.col("n_pos").cast("double") * F.col("n_neg")))


def _ks() -> Column:
    return F.max(F.abs(recall() - ratio(F.col("fp"), F.col("n_neg"))))


def average_precision(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The step form: the sum of recall steps times precision."""
    return curve.groupBy(*keys).agg(_average_precision().alias("auc_pr"))


def roc_auc(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*keys).agg(_roc_auc().alias("auc_roc"))


def ks_statistic(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*keys).agg(_ks().alias("ks_statistic"))


def _best() -> Column:
    """The point with the highest F1; the lowest threshold wins a tie."""
    at = F.struct("score", "tp", "fp", "n_pos", "n_neg")
    return F.max_by(at, F.struct(f1_score(), -F.col("score")))


def best_threshold(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return (
        curve.groupBy(*keys)
        .agg(_best().alias("b"))
        .select(*keys, "b.*")
        .select(*keys, F.col("score").alias("threshold"), f1_score().alias("f1"))
    )


def confusion(df: DataFrame, threshold: float, score: str = "score", label: str = "y") -> DataFrame:
    hit, pos = F.col(score) >= threshold, F.col(label) == 1
    return df.agg(
        F.count_if(hit & pos).alias("tp"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"),
    )


def _f2(p: Column, r: Column) -> Column:
    return ratio(p * r * 5, p * 4 + r)


def threshold_metrics(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and F2 from the four cells; 0 on an empty denominator."""
    out = cells.withColumn("n_pos", F.col("tp") + F.col("fn"))
    return out.select(
        precision().alias("precision"),
        recall().alias("recall"),
        f1_score().alias("f1"),
        _f2(precision(), recall()).alias("f2"),
    )


def class_report(cells: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1 and support, accuracy, and the two averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def row(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            n.alias("support"),
        )

    zero = (ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(tn * 2, tn * 2 + fn + fp))
    one = (ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(tp * 2, tp * 2 + fp + fn))
    n0, n1 = tn + fp, tp + fn
    accuracy = ratio(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [ratio(a * n0 + b * n1, total) for a, b in zip(zero, one)]
    rows = [
        row("0", *zero, n0),
        row("1", *one, n1),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    ]
    return cells.select(F.inline(F.array(*rows)))


def reliability_curve(
    df: DataFrame, score: str = "score", label: str = "y", bins: int = 10
) -> DataFrame:
    """Mean prediction and positive share per uniform right-closed bin; no empty bins."""
    b = F.greatest(F.ceil(F.col(score) * bins) - 1, F.lit(0))
    return df.groupBy(b.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"),
        F.avg(label).alias("positive_share"),
        F.count(F.lit(1)).alias("n"),
    )


def risk_metrics(
    df: DataFrame,
    strategy: str,
    training_rows: int,
    score: str = "score",
    label: str = "y",
    keys: Sequence[str] = (),
    threshold: float | None = None,
) -> DataFrame:
    """The fixed bundle of eleven metrics as one row (per key): all from one curve."""
    curve = score_curve(df, score, label, keys)
    at = _best()
    if threshold is not None:
        # The lowest curve point at or above the given threshold holds its counts.
        point = F.struct("score", "tp", "fp", "n_pos", "n_neg")
        at = F.min_by(point, F.when(F.col("score") >= threshold, F.col("score")))
    out = curve.groupBy(*keys).agg(
        _average_precision().alias("auc_pr"),
        _roc_auc().alias("auc_roc"),
        _ks().alias("ks_statistic"),
        at.alias("b"),
        F.sum(F.col("pos") + F.col("neg")).alias("test_rows"),
    )
    out = out.select(*keys, "auc_pr", "auc_roc", "ks_statistic", "test_rows", "b.*")
    out = out.fillna(0, subset=["tp", "fp"])
    # The eleven metric names.
    return out.select(
        *keys,
        "auc_pr",
        "auc_roc",
        f1_score().alias("f1"),
        _f2(precision(), recall()).alias("f2"),
        precision().alias("precision"),
        recall().alias("recall"),
        "ks_statistic",
        (F.col("score") if threshold is None else F.lit(float(threshold))).alias("threshold"),
        F.lit(training_rows).cast("bigint").alias("training_rows"),
        "test_rows",
        F.lit(strategy).alias("imbalance_strategy"),
    )
