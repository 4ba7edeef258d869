"""Inputs that lie outside the fixture: zones, odd bodies, missing times, copies, wide ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.operators import imbalance, quality, serving, split
from riskweave.sources import schema as S
from riskweave.sources import tables


def test_log_since_an_instant_of_another_zone(spark, tmp_path):
    at = dt.datetime(2024, 1, 10, 22, 0, tzinfo=dt.timezone.utc)
    log = spark.createDataFrame([("a", at)], "prediction_id string, timestamp timestamp")
    for f in S.PREDICTION_LOG_SCHEMA:
        if f.name not in log.columns:
            log = log.withColumn(f.name, F.lit(None).cast(f.dataType))
    tables.append_log(log.select([f.name for f in S.PREDICTION_LOG_SCHEMA]), str(tmp_path / "log"))
    east = dt.timezone(dt.timedelta(hours=5))
    since = dt.datetime(2024, 1, 11, 0, 30, tzinfo=east)  # 19:30 UTC of the day before
    assert tables.read_log(spark, str(tmp_path / "log"), S.PREDICTION_LOG_SCHEMA, since).count() == 1
    later = dt.datetime(2024, 1, 11, 3, 30, tzinfo=east)
    assert tables.read_log(spark, str(tmp_path / "log"), S.PREDICTION_LOG_SCHEMA, later).count() == 0


BODIES = [
    ("\n{\"TransactionAmt\": 5}", 5.0, None),
    ("\t {\"TransactionAmt\": 5}", 5.0, None),
    ("{\"TransactionAmt\": 1, \"TransactionAmt\": 2}", 2.0, None),
    ("{\"TransactionAmt\": \"7.5\"}", 7.5, None),
    ("{\"TransactionAmt\": null}", None, None),
    ("{\"TransactionAmt\": \"abc\"}", None, "not a number: TransactionAmt"),
    ("{\"TransactionAmt\": {\"v\": 1}}", None, "not a number: TransactionAmt"),
    ("{\"TransactionAmt\": 5", None, "body is no JSON object"),
    ("[5]", None, "body is no JSON object"),
    ("", None, "body is no JSON object"),
    (None, None, "body is no JSON object"),
]


def test_request_bodies(spark):
    raw = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(BODIES)], "id int, body string")
    good = {r.id: r.TransactionAmt for r in serving.parse_requests(raw, keep=("id",)).collect()}
    bad = {r.id: r.reject_reason for r in serving.rejected_requests(raw, keep=("id",)).collect()}
    assert good == {i: v for i, (_, v, reason) in enumerate(BODIES) if reason is None}
    assert bad == {i: reason for i, (_, _, reason) in enumerate(BODIES) if reason}
    empty = serving.parse_requests(spark.createDataFrame([("{}",)], "body string")).first().asDict()
    assert empty == {k: None if v is None else float(v) for k, v in S.REQUEST_DEFAULTS.items()}


@pytest.mark.parametrize("missing", [0, 1, 4, 10])
def test_missing_times_come_first(spark, missing):
    df = spark.range(200).select(
        F.col("id").alias("TransactionID"),
        F.when(F.col("id") % 10 >= missing, 1000 - F.col("id")).alias("TransactionDT"),
        (F.col("id") % 3 == 0).cast("int").alias("isFraud"),
    )
    rows = df.collect()
    order = sorted(rows, key=lambda r: (r.TransactionDT is not None, r.TransactionDT or 0, r.TransactionID))
    want = {r.TransactionID: "train" if i < 120 else "val" if i < 150 else "test" for i, r in enumerate(order)}
    assert {r.TransactionID: r.split for r in split.temporal_split(df).collect()} == want
    assert {r.TransactionID for r in split.temporal_head(df, 0.1).collect()} == {r.TransactionID for r in order[:20]}
    prepared = split.prepare_splits(df).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in prepared}["test"] == 50


def test_sample_of_repeated_keys_takes_whole_keys(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("TransactionID"))
    got = split.sample_n(df, 300, 1).groupBy("TransactionID").count().collect()
    assert [r["count"] for r in got] == [250]


def test_wide_ids_are_told_apart(spark):
    df = spark.range(1000).select(
        (F.lit(1 << 60) + F.col("id")).alias("wide"), F.col("id").alias("TransactionDT"), F.lit("x").alias("same")
    )
    row = quality.id_leak_check(df, ["wide"]).first()
    assert row.distinct_ratio == 1.0 and row.time_corr == pytest.approx(1.0)


def test_neighbours_need_features(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, None, 2.0), (3, 4.0, None)], "k long, a double, b double")
    with pytest.raises(ValueError, match="impute"):
        imbalance.nearest(df, "k", ["a", "b"], 1)
