"""Drift monitoring: baselines, PSI, rate drift, alert roll-ups.

A baseline is a handful of numbers per monitored feature (eleven percentiles, bin
counts), so it is embedded as literals and every later check is one aggregate,
whole-table or per time window.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import any_of
from riskweave.operators.order import quantile_values
from riskweave.sources.tables import trailing_window

# Bins, share floor, alert limits, training rate, window, smallest sample.
BUCKETS = 10
FLOOR = 1e-6
PSI_ALERT = 0.2
RATE_ALERT_STD = 2.0
TRAINING_RATE = 0.0351
WINDOW_DAYS = 7
MIN_PREDICTIONS = 100


@dataclass
class Baseline:
    feature: str
    mean: float | None
    std: float | None
    n: int
    percentiles: list[float]
    edges: list[float]
    counts: list[int]

    @property
    def bins(self) -> int:
        return max(0, len(self.edges) - 1)


def bin_conditions(c: Column, edges: Sequence[float], clip: bool = False) -> list[Column]:
    """One condition per bin: [lo, hi), the last [lo, hi]. ``clip`` opens both ends."""
    out = []
    last = len(edges) - 2
    for i in range(last + 1):
        low = c >= F.lit(edges[i]) if not (clip and i == 0) else c.isNotNull()
        if i == last:
            high = c.isNotNull() if clip else c <= F.lit(edges[i + 1])
        else:
            high = c < F.lit(edges[i + 1])
        out.append(low & high)
    return out


def fit_baselines(
    df: DataFrame, features: Sequence[str], buckets: int = BUCKETS, clip: bool = False
) -> list[Baseline]:
    """Mean, population deviation, percentiles and bin counts per feature."""
    probs = [i / buckets for i in range(buckets + 1)]
    q = quantile_values(df, features, probs)
    edges = {
        f: sorted({q[f, p] for p in probs if q[f, p] is not None}) for f in features
    }
    row = df.agg(
        *[
            e
            for f in features
            for e in (
                F.avg(f).alias(f"{f}_mean"),
                F.stddev_pop(f).alias(f"{f}_std"),
                F.count(f).alias(f"{f}_n"),
                *[
                    F.count_if(c).alias(f"{f}_b{i}")
                    for i, c in enumerate(bin_conditions(F.col(f), edges[f], clip))
                ],
            )
        ]
    ).first()
    return [
        Baseline(
            f,
            row[f"{f}_mean"],
            row[f"{f}_std"],
            row[f"{f}_n"],
            [q[f, p] for p in probs],
            edges[f],
            [row[f"{f}_b{i}"] for i in range(max(0, len(edges[f]) - 1))],
        )
        for f in features
    ]


def baseline_table(spark: SparkSession, baselines: Sequence[Baseline]) -> DataFrame:
    return spark.createDataFrame(
        [(b.feature, b.mean, b.std, b.n, b.percentiles) for b in baselines],
        "feature string, mean double, std double, n bigint, percentiles array<double>",
    )


def save_baselines(spark: SparkSession, baselines: Sequence[Baseline], path: str) -> None:
    rows = [(json.dumps(asdict(b)),) for b in baselines]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path)


def load_baselines(spark: SparkSession, path: str) -> list[Baseline]:
    return [Baseline(**json.loads(r[0])) for r in spark.read.text(path).collect()]


def _psi_of(b: Baseline, seen: Sequence[Column], in_range: Column) -> Column:
    """PSI of the counts of a baseline's bins; NULL when nothing is in range."""
    total = sum(b.counts)
    out = F.lit(0.0)
    for count, s in zip(b.counts, seen, strict=True):
        e = F.lit(max(count / total, FLOOR))
        a = F.greatest(F.try_divide(s.cast("double"), in_range.cast("double")), F.lit(FLOOR))
        out = out + (a - e) * F.ln(a / e)
    return F.when(in_range > 0, out)


def psi_expression(b: Baseline, clip: bool = False) -> Column:
    """PSI of the aggregated rows against the baseline, as one aggregate expression.

    0 for a constant baseline; NULL when no row falls in range.
    """
    if b.bins == 0:
        return F.lit(0.0)
    bins = bin_conditions(F.col(b.feature), b.edges, clip)
    return _psi_of(b, [F.count_if(c) for c in bins], F.count_if(any_of(bins)))


def psi(df: DataFrame, baseline: Baseline, clip: bool = False) -> DataFrame:
    return df.agg(
        psi_expression(baseline, clip).alias("psi"), F.lit(baseline.bins).alias("bins")
    )


def drift_rows(
    df: DataFrame,
    baselines: Sequence[Baseline],
    keys: Sequence[Column] = (),
    alert_at: float = PSI_ALERT,
    window_days: int = WINDOW_DAYS,
) -> DataFrame:
    """One row per feature (and key): PSI, alert, both means. One pass over ``df``."""
    names = [f"_k{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)])
    one = grouped.agg(
        *[
            e
            for b in baselines
            for e in (
                psi_expression(b).alias(f"{b.feature}_psi"),
                F.avg(b.feature).alias(f"{b.feature}_mean"),
                F.count(b.feature).alias(f"{b.feature}_n"),
            )
        ]
    )
    return _feature_rows(one, names, baselines, alert_at, window_days)


def _feature_rows(
    one: DataFrame, names: Sequence[str], baselines: Sequence[Baseline], alert_at: float, window_days: int
) -> DataFrame:
    """Drift-log rows of the columns <feature>_psi, _mean and _n."""
    entries = F.array(
        *[
            F.struct(
                F.lit(b.feature).alias("feature_name"),
                F.col(f"{b.feature}_psi").alias("psi_score"),
                F.coalesce(F.col(f"{b.feature}_psi") > alert_at, F.lit(True)).alias("alert_fired"),
                F.lit(b.mean).cast("double").alias("baseline_mean"),
                F.col(f"{b.feature}_mean").alias("current_mean"),
                F.lit(window_days).alias("window_days"),
                F.col(f"{b.feature}_n").alias("_n"),
            )
            for b in baselines
        ]
    )
    return one.select(*names, F.inline(entries)).filter(F.col("_n") > 0).drop("_n")


def feature_drift(
    df: DataFrame, baselines: Sequence[Baseline], as_of: dt.datetime, time: str,
    days: int = WINDOW_DAYS,
) -> DataFrame:
    """Drift of the window that ends at ``as_of``; no rows when the window is empty."""
    return drift_rows(trailing_window(df, as_of, days=days, time=time), baselines, window_days=days)


def rate_drift(
    log: DataFrame,
    keys: Sequence[Column] = (),
    training_rate: float = TRAINING_RATE,
    min_rows: int = MIN_PREDICTIONS,
    window_days: int = WINDOW_DAYS,
) -> DataFrame:
    """Deviation of the predicted rate from the training rate in binomial deviations."""
    names = [f"_k{i}" for i in range(len(keys))]
    one = log.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("rate")
    )
    return _rate_rows(one, names, training_rate, min_rows, window_days)


def _rate_rows(
    one: DataFrame, names: Sequence[str], training_rate: float, min_rows: int, window_days: int
) -> DataFrame:
    """Drift-log rows of the columns n and rate."""
    p = F.lit(training_rate)
    z = F.abs(F.col("rate") - p) / F.sqrt(p * (F.lit(1.0) - p) / F.col("n"))
    return one.filter(F.col("n") >= min_rows).select(
        *names,
        F.lit("fraud_rate").alias("feature_name"),
        z.alias("psi_score"),
        (z > RATE_ALERT_STD).alias("alert_fired"),
        p.alias("baseline_mean"),
        F.col("rate").alias("current_mean"),
        F.lit(window_days).alias("window_days"),
    )


# --- panes: what a drift check needs of one day -----------------------------------------------


def pane_columns(baselines: Sequence[Baseline]) -> list[str]:
    """Columns of a pane that add up: bin counts, sum and rows of each feature, and of predictions."""
    out = []
    for b in baselines:
        out += [f"{b.feature}_b{i}" for i in range(b.bins)] + [f"{b.feature}_sum", f"{b.feature}_n"]
    return [*out, "prediction_sum", "prediction_n"]


def panes(df: DataFrame, baselines: Sequence[Baseline], day: str = "day") -> DataFrame:
    """One row per day: its bin counts, sums and numbers of rows. One pass over ``df``.

    ``df`` has the features and ``prediction`` (0 or 1); a row may lack any of them.
    """
    aggs = []
    for b in baselines:
        bins = bin_conditions(F.col(b.feature), b.edges) if b.bins else []
        aggs += [F.count_if(c) for c in bins] + [F.sum(F.col(b.feature).cast("double")), F.count(b.feature)]
    aggs += [F.sum(F.col("prediction").cast("double")), F.count("prediction")]
    names = pane_columns(baselines)
    return df.groupBy(day).agg(*[a.alias(n) for a, n in zip(aggs, names, strict=True)])


def merged_panes(both: DataFrame, baselines: Sequence[Baseline], day: str = "day") -> DataFrame:
    return both.groupBy(day).agg(*[F.sum(c).alias(c) for c in pane_columns(baselines)])


def pane_check(
    kept: DataFrame, baselines: Sequence[Baseline], window_days: int = WINDOW_DAYS,
    min_rows: int = MIN_PREDICTIONS, alert_at: float = PSI_ALERT,
) -> DataFrame:
    """The drift-log rows of all ``kept`` panes together, as ``drift_rows`` and ``rate_drift`` give them."""
    one = kept.agg(*[F.sum(c).alias(c) for c in pane_columns(baselines)])
    new = {"n": F.coalesce("prediction_n", F.lit(0)), "rate": F.try_divide("prediction_sum", "prediction_n")}
    for b in baselines:
        seen = [F.col(f"{b.feature}_b{i}") for i in range(b.bins)]
        new[f"{b.feature}_psi"] = _psi_of(b, seen, sum(seen[1:], seen[0])) if seen else F.lit(0.0)
        new[f"{b.feature}_mean"] = F.try_divide(f"{b.feature}_sum", f"{b.feature}_n")
    one = one.withColumns(new)
    features = _feature_rows(one, [], baselines, alert_at, window_days)
    return features.unionByName(_rate_rows(one, [], TRAINING_RATE, min_rows, window_days))


def drift_summary(features: DataFrame, rate: DataFrame) -> DataFrame:
    both = features.unionByName(rate)
    return both.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("alert_fired").alias("alerts"),
        F.coalesce(F.bool_or("alert_fired"), F.lit(False)).alias("any_alert"),
    )


def drift_log(
    txn: DataFrame, log: DataFrame, baselines: Sequence[Baseline], time: str, every: str,
    min_rows: int,
) -> DataFrame:
    """Drift checks of every window of length ``every``, as drift-log rows."""
    f = drift_rows(txn, baselines, [F.window(time, every).getField("start")])
    r = rate_drift(log, [F.window("timestamp", every).getField("start")], min_rows=min_rows)
    return f.unionByName(r).withColumnRenamed("_k0", "timestamp")


def recent_log(log: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Dashboard scan: the last days by calendar date, in time order."""
    first = (as_of - dt.timedelta(days=days)).date()
    return log.filter(F.to_date("timestamp") >= F.lit(first)).orderBy("timestamp", "feature_name")


def alert_history(log: DataFrame) -> DataFrame:
    return log.filter((F.col("feature_name") != "fraud_rate") & F.col("alert_fired"))


def alert_daily_max(log: DataFrame, limits: dict[str, float], default: float) -> DataFrame:
    """Days on which a metric's maximum exceeds its limit."""
    limit = F.coalesce(
        F.element_at(
            F.create_map(*[F.lit(x) for item in limits.items() for x in item]),
            F.col("feature_name"),
        ),
        F.lit(default),
    )
    return (
        log.groupBy(F.window("timestamp", "1 day").getField("start").alias("day"), "feature_name")
        .agg(F.max("psi_score").alias("max_score"))
        .filter(F.col("max_score") > limit)
    )
