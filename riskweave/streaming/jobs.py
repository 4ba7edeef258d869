"""Structured Streaming jobs. Each body is the batch operator applied to a stream.

Sources are Parquet folders (``available now`` runs to the end of the input and stops).
Sinks are Parquet tables with a checkpoint, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators import drift, serving
from riskweave.operators.features import FeatureEngineer, align_features
from riskweave.session import exists, remove
from riskweave.sources import schema as S

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, only: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_end(writer) -> StreamingQuery:
    """Process everything that is there now, then stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def to_table(df: DataFrame, path: str, mode: str = "append", by: Sequence[str] = ()) -> StreamingQuery:
    """Run a stream into a Parquet table (exactly once: file log plus checkpoint)."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint")
    )
    return run_to_end(writer.partitionBy(*by) if by else writer)


def score_requests(
    requests: DataFrame,
    engineer: FeatureEngineer,
    score: Callable[[DataFrame], DataFrame],
    features: Sequence[str],
    threshold: float,
    version: str,
    time: str = "timestamp",
) -> DataFrame:
    """JSON bodies to prediction-log rows: defaults, engineering, alignment, score.

    Works on batches and streams; the state tables join as static sides.
    """
    parsed = serving.parse_requests(requests, keep=(S.KEY, time), expected=list(engineer.medians))
    typed = parsed.withColumns(
        {S.TIME: F.col(S.TIME).cast("bigint"), "card1": F.col("card1").cast("bigint")}
    )
    rows = align_features(engineer.transform(typed), features, keep=[S.KEY, time])
    return serving.log_rows(score(rows), threshold, version, time)


def log_once(log: DataFrame, path: str) -> None:
    """Run a stream of predictions into a day-partitioned log that holds each prediction id once.

    A batch writes the ids that the log does not have yet for their days, however much later a
    repeat arrives; only the days it touches are read. Its rows go to partitions of its own
    (``date``, ``batch``), which a retry overwrites: a failure between the write and the commit
    leaves no row twice. A repeat has the timestamp of its prediction.
    """
    spark = log.sparkSession
    table = f"{path}/table"
    known = T.StructType(
        [T.StructField("prediction_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("batch", T.LongType())]
    )

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("date", F.to_date("timestamp"))
        # One row of each id, the first by time; it is picked before the shuffle.
        rest = [c for c in rows.columns if c != "prediction_id"]
        first = F.min_by(F.struct(*rest), F.col("timestamp")).alias("r")
        rows = rows.groupBy("prediction_id").agg(first).select("prediction_id", *[f"r.{c}" for c in rest])
        if exists(spark, table):
            days = [r[0] for r in batch.select(F.to_date("timestamp")).distinct().collect()]
            there = spark.read.schema(known).parquet(table)
            there = there.filter(F.col("date").isin(days) & (F.col("batch") < number))
            rows = rows.join(there, ["prediction_id", "date"], "left_anti")
        (
            rows.withColumn("batch", F.lit(number).cast("long"))
            .hint("rebalance", F.col("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "batch")
            .parquet(table)
        )

    run_to_end(log.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint"))


def windowed_rates(
    log: DataFrame, path: str, length: str, slide: str | None = None, late: str = "1 hour"
) -> None:
    """Run a log to its end into panes (``path``/panes) and closed windows (``path``/table).

    The stream keeps the counts of open panes only, whatever the windows overlap; a pane is written
    once the watermark passes its end, and rows of written panes that come later are dropped. After
    each run, the windows that the watermark has passed since the run before are made
    of the panes they span, exactly as in a batch.
    """
    spark, slide = log.sparkSession, slide or length
    counts = serving.pane_counts(log.withWatermark("timestamp", late), slide)
    day = F.floor(F.col("pane") / 86_400).alias("day")
    query = to_table(counts.select("*", day), f"{path}/panes", by=["day"])
    now = watermark(query)
    done = f"{path}/until"
    before = max((r[0] for r in spark.read.schema("until long").parquet(done).collect()), default=0) if exists(spark, done) else 0
    if now <= before:
        return
    size = serving.seconds(length)
    written = spark.read.schema("pane long, latency_ms double, prediction int, w long, day long").parquet(f"{path}/panes/table")
    # No window that closes now begins before this.
    open_ = written.filter((F.col("day") >= (before - size) // 86_400) & (F.col("pane") > before - size))
    end = F.col("w.end").cast("long")
    closed = serving.window_metrics(open_.drop("day"), length, slide).filter((end > before) & (end <= now))
    closed.write.mode("overwrite").parquet(f"{path}/table/until={now}")
    spark.createDataFrame([(now,)], "until long").coalesce(1).write.mode("append").parquet(done)


def watermark(query: StreamingQuery) -> int:
    """The watermark of a query that has ended, in whole seconds; 0 if it saw nothing."""
    stamps = [p["eventTime"].get("watermark") for p in query.recentProgress if p["eventTime"]]
    last = max((x for x in stamps if x), default="1970-01-01T00:00:00.000Z")
    return int(dt.datetime.fromisoformat(last.replace("Z", "+00:00")).timestamp())


def windowed_rate_drift(
    log: DataFrame, length: str, slide: str, late: str = "1 hour", min_rows: int = 100
) -> DataFrame:
    """Rate drift per sliding event-time window."""
    start: Column = F.window("timestamp", length, slide)
    out = drift.rate_drift(log.withWatermark("timestamp", late), [start], min_rows=min_rows)
    return out.withColumnRenamed("_k0", "w")


def drift_checks(
    arriving: DataFrame,
    baselines: Sequence[drift.Baseline],
    path: str,
    days: int = drift.WINDOW_DAYS,
    min_rows: int = drift.MIN_PREDICTIONS,
) -> None:
    """Scheduled drift checks: at each micro-batch, one set of drift-log rows over the trailing days.

    ``arriving`` has ``day`` (a whole number), the features and ``prediction``; a row may lack any
    of them. The state is one pane a day (``drift.panes``): a batch adds its rows to the panes of
    the batch before, days that have left the window expire, and the check sums what is left. So
    work and state do not grow with what has arrived, and a late row counts as long as its day
    is in the window. A window ends with the latest day seen (``as_of``). Panes and rows of a
    batch are written to folders of their own, out of the panes of the batch before: a retry
    after a failure writes them again.
    """
    spark = arriving.sparkSession

    def panes_of(number: int) -> str:
        return f"{path}/panes/{number}"

    def check(batch: DataFrame, number: int) -> None:
        now = drift.panes(batch.filter("day is not null"), baselines)
        if number:
            now = now.unionByName(spark.read.parquet(panes_of(number - 1)))
        now = drift.merged_panes(now, baselines)
        last = F.max("day").over(Window.partitionBy(F.lit(0)))  # a pane a day: few rows
        kept = now.withColumn("last", last).filter(F.col("day") > F.col("last") - days).drop("last")
        kept.coalesce(1).write.mode("overwrite").parquet(panes_of(number))
        kept = spark.read.schema(kept.schema).parquet(panes_of(number))
        as_of = kept.agg(F.max("day")).first()[0]
        rows = drift.pane_check(kept, baselines, days, min_rows).withColumn("as_of", F.lit(as_of).cast("long"))
        rows.write.mode("overwrite").parquet(f"{path}/table/batch={number}")
        if number > 1:
            remove(spark, panes_of(number - 2))

    run_to_end(
        arriving.writeStream.foreachBatch(check).option("checkpointLocation", f"{path}/checkpoint")
    )
