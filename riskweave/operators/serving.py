"""Scoring requests and serving logs as batch operators (also the streams' bodies)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import decide, r6
from riskweave.operators.order import quantile_table, range_edges, with_ranges
from riskweave.session import stored
from riskweave.sources import schema as S
from riskweave.sources.tables import trailing_window

LATENCIES = {0.5: "p50_latency_ms", 0.95: "p95_latency_ms", 0.99: "p99_latency_ms"}


def read_requests(
    df: DataFrame,
    body: str = "body",
    keep: Sequence[str] = (),
    expected: Sequence[str] = (),
) -> DataFrame:
    """JSON bodies to typed columns, and ``reject_reason`` (NULL for a sound request).

    Absent fields get their default, explicit nulls stay NULL, and the last of a repeated
    field counts. A body that is no JSON object, or a field that is no number, is a
    reason to reject the request; it never ends the job.
    """
    names = [*[c for c in expected if c not in keep and c not in S.REQUEST_DEFAULTS],
             *S.REQUEST_DEFAULTS]
    schema = "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">"
    # Generated rather than projected: a body is parsed once, not once per field.
    parsed = df.select(
        *keep,
        F.inline(
            F.array(
                F.struct(
                    F.from_json(body, schema).alias("_given"),
                    F.json_object_keys(body).alias("_keys"),
                )
            )
        ),
    )

    def number(n: str) -> Column:
        given = F.col(f"_given.{n}").try_cast("double")
        default = S.REQUEST_DEFAULTS.get(n)
        if default is None:
            return given
        return F.when(F.array_contains("_keys", n), given).otherwise(F.lit(float(default)))

    bad = [
        F.when(F.col(f"_given.{n}").isNotNull() & F.col(f"_given.{n}").try_cast("double").isNull(), F.lit(n))
        for n in names
    ]
    bad_names = F.array_join(F.array_compact(F.array(*bad)), ",")
    reason = F.when(F.col("_keys").isNull(), "body is no JSON object").when(
        bad_names != "", F.concat(F.lit("not a number: "), bad_names)
    )
    return parsed.select(*keep, *[number(n).alias(n) for n in names], reason.alias("reject_reason"))


def parse_requests(
    df: DataFrame,
    body: str = "body",
    keep: Sequence[str] = (),
    expected: Sequence[str] = (),
) -> DataFrame:
    """The sound requests as typed columns; see ``read_requests``."""
    rows = read_requests(df, body, keep, expected)
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_requests(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., reject_reason) of the requests that ``parse_requests`` leaves out."""
    rows = read_requests(df, body, keep)
    return rows.filter(F.col("reject_reason").isNotNull()).select(*keep, "reject_reason")


def prediction_id(version: str) -> Column:
    """A repeatable id from key and model version."""
    return F.sha2(F.concat_ws("|", F.col(S.KEY).cast("string"), F.lit(version)), 256).alias("prediction_id")


def log_rows(scored: DataFrame, threshold: float, version: str, time: str) -> DataFrame:
    """Prediction-log rows with the repeatable id."""
    p = F.col("probability")
    return scored.select(
        prediction_id(version),
        F.col(time).cast("timestamp").alias("timestamp"),
        r6(p).alias("fraud_probability"),
        decide(p, threshold).alias("prediction"),
        F.lit(round(threshold, 6)).alias("threshold_used"),
        F.lit(version).alias("model_version"),
    )


def serving_metrics(
    log: DataFrame, as_of: dt.datetime, hours: int = 24, approx: bool = False
) -> DataFrame:
    """Totals, rate and latency of the trailing window; zeros when it is empty."""
    rows = trailing_window(log, as_of, hours=hours)
    zero = F.lit(0.0)
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.avg("prediction"), zero).alias("fraud_rate"),
        F.coalesce(F.avg("latency_ms"), zero).alias("avg_latency_ms"),
    ]
    if approx:
        return rows.agg(
            *aggs,
            *[F.percentile_approx("latency_ms", p).alias(n) for p, n in LATENCIES.items()],
        ).fillna(0.0)
    q = quantile_table(rows, ["latency_ms"], list(LATENCIES)).agg(
        *[
            F.coalesce(F.max(F.when(F.col("prob") == p, F.col("value"))), zero).alias(n)
            for p, n in LATENCIES.items()
        ]
    )
    return rows.agg(*aggs).crossJoin(F.broadcast(q))  # one row on either side


def predictions_on(log: DataFrame, day: dt.date) -> DataFrame:
    return log.filter(F.to_date("timestamp") == F.lit(day)).agg(
        F.count(F.lit(1)).alias("predictions_today")
    )


# Value ranges that percentiles of windows are looked up in.
LATENCY_RANGES = 256
_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def seconds(interval: str) -> int:
    """Seconds of an interval like "24 hours"."""
    n, unit = interval.split()
    return int(n) * _SECONDS[unit.rstrip("s").lower()]


def pane_counts(log: DataFrame, length: str) -> DataFrame:
    """(pane, latency_ms, prediction, w): how often each pair of values occurs in each pane.

    A pane is a tumbling window, by its start in seconds. For batches and streams.
    """
    pane = F.window("timestamp", length)
    counts = log.groupBy(pane.alias("_w"), "latency_ms", "prediction").agg(F.count(F.lit(1)).alias("w"))
    return counts.select(F.unix_timestamp("_w.start").alias("pane"), "latency_ms", "prediction", "w")


def window_metrics(counts: DataFrame, length: str, slide: str) -> DataFrame:
    """Count, predicted rate and latency of each sliding window, from the panes of one slide each.

    Exact, whatever a window holds: rows of the log are not copied to their windows. Panes add up
    to windows; for percentiles, counts of value ranges do, and only the values of the range that
    holds a wanted rank go to their windows. ``counts`` is read several times. ``length`` must
    be a whole number of slides.
    """
    size, step = seconds(length), seconds(slide)
    if size % step:
        raise ValueError(f"{length} is no whole number of {slide}")
    starts = F.explode(F.sequence(F.col("pane") - (size - step), F.col("pane"), F.lit(step)))
    seen = F.col("latency_ms").isNotNull()
    total = {
        "n": "w", "_p": F.col("prediction") * F.col("w"), "_pn": F.when(F.col("prediction").isNotNull(), F.col("w")),
        "_l": F.col("latency_ms") * F.col("w"), "_ln": F.when(seen, F.col("w")),
    }
    panes = counts.groupBy("pane").agg(*[F.sum(c).alias(n) for n, c in total.items()], F.max("latency_ms").alias("_m"))
    windows = panes.withColumn("start", starts).groupBy("start").agg(*[F.sum(n).alias(n) for n in total], F.max("_m").alias("_m"))

    edges = range_edges(counts.filter(seen), ["latency_ms"], LATENCY_RANGES)
    cut = with_ranges(counts.filter(seen), edges).withColumnRenamed("_range_latency_ms", "cell")
    # Ranks by range: a row for each window and range.
    cells = cut.groupBy("pane", "cell").agg(F.sum("w").alias("w")).withColumn("start", starts)
    cells = cells.groupBy("start", "cell").agg(F.sum("w").alias("w"))
    whole = Window.partitionBy("start")
    earlier = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    n, before = F.sum("w").over(whole), F.coalesce(F.sum("w").over(earlier), F.lit(0))
    rank = F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("prob") * F.col("n"))) - 1 - F.col("before")
    wanted = cells.withColumns({"n": n, "before": before}).withColumn("prob", F.explode(F.array(*map(F.lit, LATENCIES))))
    wanted = wanted.withColumn("rank", rank).filter((F.col("rank") >= 0) & (F.col("rank") < F.col("w")))
    panes_of = F.explode(F.sequence(F.col("start"), F.col("start") + (size - step), F.lit(step)))
    wanted = wanted.select("start", "cell", "prob", "rank", panes_of.alias("pane"))
    values = cut.groupBy("pane", "cell", "latency_ms").agg(F.sum("w").alias("w")).join(wanted, ["pane", "cell"])
    values = values.groupBy("start", "prob", "rank", "latency_ms").agg(F.sum("w").alias("w"))
    upto = Window.partitionBy("start", "prob").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.when(F.sum("w").over(upto) > F.col("rank"), F.col("latency_ms"))
    percentiles = values.select("start", "prob", hit.alias("v")).groupBy("start").agg(
        *[F.min(F.when(F.col("prob") == p, F.col("v"))).alias(name) for p, name in LATENCIES.items()]
    )
    stamp = lambda c: F.timestamp_seconds(c)
    return windows.join(percentiles, "start", "left").select(
        F.struct(stamp(F.col("start")).alias("start"), stamp(F.col("start") + size).alias("end")).alias("w"),
        "n",
        F.try_divide("_p", "_pn").alias("rate"),
        F.try_divide("_l", "_ln").alias("avg_latency_ms"),
        F.col("_m").alias("max_latency_ms"),
        *LATENCIES.values(),
    )


def windowed_rate(log: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Count, predicted rate and latency per event-time window of a batch."""
    return window_metrics(stored(pane_counts(log, slide or length), "panes"), length, slide or length)
