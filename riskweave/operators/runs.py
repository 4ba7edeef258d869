"""Experiment runs as tables: long metrics and parameters, comparison, champion, deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import r6


class NoRuns(ValueError):
    pass


def runs_pivot(metrics: DataFrame, params: DataFrame, m: Sequence[str], p: Sequence[str]):
    """One row per run: its metrics, and its parameters with the ``param_`` prefix."""
    left = metrics.groupBy("run_name").pivot("name", list(m)).agg(F.first("value"))
    right = params.groupBy("run_name").pivot("name", list(p)).agg(F.first("value"))
    renamed = right.select("run_name", *[F.col(c).alias(f"param_{c}") for c in p])
    return left.join(renamed, "run_name", "left")


def champion(runs: DataFrame, metric: str = "auc_pr", order: str = "run_order") -> DataFrame:
    """The best run; the earlier one wins a tie."""
    best = F.max_by(F.struct("*"), F.struct(F.col(metric), -F.col(order)))
    return runs.agg(best.alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def require_champion(runs: DataFrame, metric: str = "auc_pr") -> dict:
    row = champion(runs, metric).first()
    if row is None:
        raise NoRuns("no runs to choose from")
    return row.asDict()


def comparison_table(runs: DataFrame, metrics: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Metrics as rows, runs as columns."""
    long = runs.unpivot("run_name", list(metrics), "metric", "value")
    return long.groupBy("metric").pivot("run_name", list(names)).agg(F.first("value"))


def running_best(trials: DataFrame, run: Sequence[str], step: str, metric: str) -> DataFrame:
    """Best value of the earlier trials, and whether this one is strictly better."""
    earlier = Window.partitionBy(*run).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max(metric).over(earlier)
    return trials.withColumn("best_before", prev).withColumn(
        "is_best", F.col("best_before").isNull() | (F.col(metric) > F.col("best_before"))
    )


def convergence(curve: DataFrame, run: str, step: str, metric: str, share: float = 0.95):
    """Best iteration per run (the first on ties); converged when it comes early enough."""
    return (
        curve.groupBy(run)
        .agg(
            F.max_by(step, F.struct(F.col(metric), -F.col(step))).alias("best_iteration"),
            F.max(step).alias("iterations"),
        )
        .withColumn("converged", F.col("best_iteration") < F.col("iterations") * F.lit(share))
    )


def ablation_delta(
    runs: DataFrame, metric: str = "auc_pr", order: str = "run_order", band: float = 0.02
) -> DataFrame:
    """Change against the previous run, and what it means."""
    before = runs.select(
        (F.col(order) + 1).alias(order),
        F.col("run_name").alias("previous_run"),
        F.col(metric).alias("_before"),
    )
    delta = r6(F.col(metric) - F.col("_before"))
    return (
        runs.join(before, order)
        .withColumn("delta", delta)
        .withColumn(
            "meaning",
            F.when(F.col("delta") > band, "improved")
            .when(F.col("delta") < -band, "degraded")
            .otherwise("unchanged"),
        )
        .drop("_before")
    )


def report_text(metrics: DataFrame) -> DataFrame:
    """The one-sentence summary of a metric row."""
    # The wording of the sentence.
    text = F.format_string(
        "At threshold %.4f: Precision=%.3f (of flagged transactions, %.1f%% are fraud), "
        "Recall=%.3f (%.1f%% of fraud transactions caught).",
        F.col("threshold"),
        F.col("precision"),
        F.col("precision") * 100,
        F.col("recall"),
        F.col("recall") * 100,
    )
    return metrics.select("threshold", "precision", "recall", text.alias("report"))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON line per run, appended."""
    metrics.coalesce(1).write.mode("append").json(path)
