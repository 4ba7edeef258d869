import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import quality
from riskweave.operators.profile import null_profile
from riskweave.sources import schema as S
from riskweave.sources import tables
from riskweave.sources.feature_store import FeatureStore

UTC = dt.timezone.utc


def test_declared_schemas():
    assert len(S.TRANSACTION_SCHEMA) == 394
    assert len(S.IDENTITY_SCHEMA) == 41
    names = S.TRANSACTION_SCHEMA.names
    assert names[:6] == ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1"]
    assert names[-1] == "V339" and "M9" in names and "D15" in names
    assert not S.TRANSACTION_SCHEMA["TransactionID"].nullable
    assert all(f.dataType == T.StringType() for f in S.IDENTITY_SCHEMA if f.name.startswith("id_"))
    assert S.IDENTITY_SCHEMA.names[1] == "id_01"
    assert len(S.REQUEST_DEFAULTS) == 39 and len(S.REGISTERED_FEATURES) == 48


@pytest.mark.parametrize("root,prefix,name,want", [
    ("s3://bucket", "raw/", "a.csv", "s3://bucket/raw/a.csv"),
    ("s3://bucket/", "/raw", "/a.csv", "s3://bucket/raw/a.csv"),
    ("/data", "", "a.csv", "/data/a.csv"),
])
def test_input_path(root, prefix, name, want):
    assert tables.input_path(root, prefix, name) == want


SMALL = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])


def test_csv_nulls_and_newlines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,x,s\n1,2.5,"two\nlines"\n2,,\n3,NaN,z\n')
    out = tables.load_csv(spark, str(tmp_path / "a.csv"), SMALL, str(tmp_path / "t"), multiline=True)
    got = {r["id"]: (r["x"], r["s"]) for r in out.collect()}
    assert got == {1: (2.5, "two\nlines"), 2: (None, None), 3: (None, "z")}
    # a second load replaces the table
    (tmp_path / "b.csv").write_text("id,x,s\n9,1,q\n")
    out = tables.load_csv(spark, str(tmp_path / "b.csv"), SMALL, str(tmp_path / "t"))
    assert [r["id"] for r in out.collect()] == [9]


def test_csv_fails_on_bad_cell(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x,s\n1,oops,a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|oops"):
        tables.read_typed_csv(spark, str(tmp_path / "a.csv"), SMALL).collect()


def log(spark, days):
    rows = [(f"p{i}", dt.datetime(2024, 1, d, 5, tzinfo=UTC), 0.5, 1, 0.5, 10.0, "m") for i, d in enumerate(days)]
    return spark.createDataFrame(rows, S.PREDICTION_LOG_SCHEMA)


def test_log_append_and_pruning(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_log(log(spark, [1, 2, 3]), path)
    tables.append_log(log(spark, [3, 4]), path)
    assert tables.read_log(spark, path, S.PREDICTION_LOG_SCHEMA).count() == 5
    recent = tables.read_log(spark, path, S.PREDICTION_LOG_SCHEMA, since=dt.datetime(2024, 1, 3, tzinfo=UTC))
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_upsert_latest_wins(spark):
    a = spark.createDataFrame([("k", 1, 1.0), ("q", 5, 9.0)], "k string, t int, v double")
    b = spark.createDataFrame([("k", 2, 2.0), ("q", 4, 8.0)], "k string, t int, v double")
    out = {r["k"]: r["v"] for r in tables.upsert_features(a, b, "k", ["t"]).collect()}
    assert out == {"k": 2.0, "q": 9.0}


def test_registry_adds_only_new(spark):
    found = spark.createDataFrame([("card1",), ("brand_new",)], "feature string")
    assert [r[0] for r in tables.unregistered(found, tables.registry(spark)).collect()] == ["brand_new"]


# --- table checks ----------------------------------------------------------------------


def stats(spark, total=590540, null_id=0, null_label=0, rate=3.5, unique=590540):
    return spark.createDataFrame(
        [(total, null_id, null_label, rate, unique)],
        "total_joined bigint, null_txn_ids bigint, null_labels bigint, fraud_rate_pct double, unique_txn_ids bigint",
    )


@pytest.mark.parametrize("change,failed", [
    ({}, []),
    ({"null_id": 5}, ["no_null_transaction_ids"]),
    ({"null_label": 3}, ["no_null_labels"]),
    ({"rate": 10.0}, ["fraud_rate_in_range"]),
    ({"unique": 590000}, ["unique_transaction_ids"]),
])
def test_integrity_outcomes(spark, change, failed):
    checks = quality.integrity_checks(stats(spark, **change), 0.03, 0.05)
    if not failed:
        quality.require(checks)
        return
    with pytest.raises(quality.Violation) as e:
        quality.require(checks)
    assert e.value.failed == failed


def test_validate_reports_or_raises(spark):
    df = spark.range(10)
    assert not quality.validate_table(df, "t", 11).first()["passed"]
    with pytest.raises(quality.Violation):
        quality.validate_table(df, "t", 11, strict=True)


def test_join_keeps_all_transactions(spark):
    t = spark.createDataFrame([(1, 0), (2, 1)], "TransactionID bigint, isFraud int")
    i = spark.createDataFrame([(2, "x")], "TransactionID bigint, id_01 string")
    out = quality.join_identity(t, i)
    assert out.columns == ["TransactionID", "isFraud", "id_01"]
    assert {r[0]: r[2] for r in out.collect()} == {1: None, 2: "x"}


def test_missing_report_fails_the_gate(spark):
    empty = spark.createDataFrame([], "run_name string, run_order int, auc_pr double")
    assert quality.model_gate(empty, 0.48).first()["passed"] is False


def test_families(spark):
    df = spark.createDataFrame([(1.0,) * 8], "V1 double, C1 double, D1 double, M1 double, id_01 double, card1 double, addr1 double, x double")
    got = {r["column"]: r["family"] for r in null_profile(df, df.columns).collect()}
    assert got == {"V1": "V", "C1": "C", "D1": "D", "M1": "M", "id_01": "id_", "card1": "card", "addr1": "addr", "x": "other"}


def test_feature_gate_on_sample(spark):
    df = spark.range(1000).select(F.col("id").alias("TransactionID"), F.col("id").cast("double").alias("a"))
    row = quality.feature_gate(df, ["a"], 1, sample_rows=500).first()
    assert row["rows"] == 500 and row["passed"]
    assert not quality.feature_gate(df, ["a"], 2).first()["passed"]


# --- stored tables -------------------------------------------------------------------------


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    reader = tables.current_table(spark, path)
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(bad, path)
    assert tables.current_table(spark, path).count() == 5
    tables.replace_table(spark.range(7), path)
    assert tables.current_table(spark, path).count() == 7
    assert reader.count() == 5  # began before, goes on with its files
    tables.replace_table(spark.range(3), path)
    assert tables.current_table(spark, path).count() == 3
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == 2
    with pytest.raises(FileNotFoundError):
        tables.current_table(spark, str(tmp_path / "none"))


def files(tmp_path):
    return {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}


def test_a_merge_rewrites_the_buckets_it_touches(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, t long, v double")
    store = FeatureStore(spark, str(tmp_path / "f"), schema, "k", ["t"], 32)
    first = spark.range(2000).select("id", F.lit(5).cast("long"), F.col("id").cast("double")).toDF("k", "t", "v")
    store.merge(first)
    before = files(tmp_path)
    batch = spark.createDataFrame([(3, 9, -1.0), (3, 8, -2.0), (4, 1, -3.0), (5000, 1, 7.0), (None, 1, 1.0)], schema)
    store.merge(batch)
    after = files(tmp_path)
    same = {p for p in before if after.get(p) == before[p]}
    assert len(same) >= 29 * len(before) // 32
    want = tables.upsert_features(first, batch.filter("k is not null"), "k", ["t"])
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, want.select("k", "t", "v").collect()))


def test_a_lookup_reads_few_files(spark, tmp_path, monkeypatch):
    from riskweave.sources import feature_store

    schema = T.StructType.fromDDL("k long, t long, v double")
    store = FeatureStore(spark, str(tmp_path / "f"), schema, "k", ["t"], 256)
    store.merge(spark.range(20_000).select("id", F.lit(5).cast("long"), F.col("id").cast("double")).toDF("k", "t", "v"))
    ids = spark.createDataFrame([(i,) for i in [*range(0, 10_000, 100), 10**6, None, 0]], "k long")

    found = store.lookup(ids, ["v"])
    rows = sorted(map(tuple, found.collect()))
    buckets = {r[0] for r in spark.read.parquet(store.path).join(ids, "k").select("bucket").distinct().collect()}
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "PushedFilters: [In(k" in scan
    n = sum(f"bucket={b}/" in p for p in files(tmp_path) for b in buckets)
    assert rows == [(i, float(i)) for i in range(0, 10_000, 100)]
    assert n <= 102 < len(files(tmp_path))
    monkeypatch.setattr(feature_store, "LISTED", 10)
    assert sorted(map(tuple, store.lookup(ids, ["v"]).collect())) == rows
    assert store.lookup(ids.limit(0), ["v"]).count() == 0
    empty = FeatureStore(spark, str(tmp_path / "none"), schema, "k", ["t"])
    assert empty.lookup(ids, ["v"]).collect() == []
