import math

import pytest
from pyspark.sql import functions as F

from riskweave.operators import split


def data(spark, n=400):
    """Unsorted times, a positive in every 29 rows."""
    return spark.range(n).select(
        F.col("id").alias("TransactionID"),
        ((F.col("id") * 7919) % n * 3600).alias("TransactionDT"),
        (F.col("id") % 29 == 0).cast("int").alias("isFraud"),
    )


def test_temporal_split(spark):
    out = split.temporal_split(data(spark))
    span = {r["split"]: r for r in out.groupBy("split").agg(F.count("*").alias("n"), F.min("TransactionDT").alias("lo"), F.max("TransactionDT").alias("hi")).collect()}
    assert {k: v["n"] for k, v in span.items()} == {"train": 240, "val": 60, "test": 100}
    assert span["train"]["hi"] < span["val"]["lo"] and span["val"]["hi"] < span["test"]["lo"]


@pytest.mark.parametrize("seed", [1, 42])
def test_stratified_share_is_exact(spark, seed):
    df = data(spark)
    out = df.withColumn("v", split.stratified_carve(df, 0.2, seed))
    got = {r["isFraud"]: (r["n"], r["k"]) for r in out.groupBy("isFraud").agg(F.count("*").alias("n"), F.count_if("v").alias("k")).collect()}
    for n, k in got.values():
        assert k == math.ceil(n * 0.2)


def test_prepared_splits_cover_everything(spark):
    df = data(spark)
    row = split.split_check(split.prepare_splits(df), df).first()
    assert row["split_rows"] == row["source_rows"] == 400 and row["keys_in_two_splits"] == 0


def test_fold_sizes(spark):
    out = split.ts_folds(data(spark, 103), 5)
    n = {r["block"]: r["count"] for r in out.groupBy("block").count().collect()}
    assert n == {0: 18, 1: 17, 2: 17, 3: 17, 4: 17, 5: 17}


def test_samples_repeat(spark):
    df = data(spark)
    a = {r[0] for r in split.sample_n(df, 50, 7).collect()}
    assert len(a) == 50 and a == {r[0] for r in split.sample_n(df.repartition(5), 50, 7).collect()}
    assert a != {r[0] for r in split.sample_n(df, 50, 8).collect()}
    assert split.sample_n(df, 1000, 7).count() == 400


def test_sample_over_narrowed_brackets(spark, monkeypatch):
    from riskweave.operators import order

    df = data(spark)
    a = {r[0] for r in split.sample_n(df, 50, 7).collect()}
    monkeypatch.setattr(order, "CANDIDATE_LIMIT", 0)
    assert a == {r[0] for r in split.sample_n(df, 50, 7).collect()}
