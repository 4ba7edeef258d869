import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import drift, serving

UTC = dt.timezone.utc


def frame(spark, v):
    return spark.createDataFrame([(float(x),) for x in v], "x double")


def formula(expected, actual):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, 11)))
    e, a = (np.histogram(v, edges)[0].astype(float) for v in (expected, actual))
    e, a = np.maximum(e / e.sum(), 1e-6), np.maximum(a / a.sum(), 1e-6)
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.mark.parametrize("shift", [0.0, 0.7, 2.0])
def test_psi_formula(spark, shift):
    rng = np.random.default_rng(0)
    expected, actual = np.round(rng.normal(size=900), 2), np.round(rng.normal(shift, 1, 500), 2)
    base = drift.fit_baselines(frame(spark, expected), ["x"])[0]
    row = drift.psi(frame(spark, actual), base).first()
    assert row["psi"] == pytest.approx(formula(expected, actual))


def test_constant_and_out_of_range(spark):
    base = drift.fit_baselines(frame(spark, [3, 3, 3]), ["x"])[0]
    assert drift.psi(frame(spark, [1, 2]), base).first()["psi"] == 0.0
    base = drift.fit_baselines(frame(spark, range(100)), ["x"])[0]
    rows = drift.drift_rows(frame(spark, [1000, 2000]), [base]).first()
    assert rows["psi_score"] is None and rows["alert_fired"]
    clipped = drift.fit_baselines(frame(spark, range(100)), ["x"], clip=True)[0]
    assert drift.psi(frame(spark, [1000, 2000]), clipped, clip=True).first()["psi"] > 1


def test_baseline_round_trip(spark, tmp_path):
    base = drift.fit_baselines(frame(spark, range(50)), ["x"])
    drift.save_baselines(spark, base, str(tmp_path / "b"))
    assert drift.load_baselines(spark, str(tmp_path / "b")) == base
    row = drift.baseline_table(spark, base).first()
    assert len(row["percentiles"]) == 11 and row["std"] == pytest.approx(np.std(range(50)))


def predictions(spark, n, positive):
    return spark.range(n).select((F.col("id") < positive).cast("int").alias("prediction"))


@pytest.mark.parametrize("n,pos,rows,alert", [(99, 50, 0, None), (1000, 35, 1, False), (1000, 90, 1, True)])
def test_rate_drift(spark, n, pos, rows, alert):
    out = drift.rate_drift(predictions(spark, n, pos)).collect()
    assert len(out) == rows
    if rows:
        z = abs(pos / n - 0.0351) / np.sqrt(0.0351 * (1 - 0.0351) / n)
        assert out[0]["psi_score"] == pytest.approx(z) and out[0]["alert_fired"] is alert


def test_empty_window(spark):
    log = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, tzinfo=UTC), 1, 10.0)], "timestamp timestamp, prediction int, latency_ms double")
    row = serving.serving_metrics(log, dt.datetime(2030, 1, 1, tzinfo=UTC)).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    approx = serving.serving_metrics(log, dt.datetime(2024, 1, 1, 1, tzinfo=UTC), approx=True).first()
    assert approx["p95_latency_ms"] == 10.0


def test_request_defaults(spark):
    df = spark.createDataFrame([('{"TransactionAmt": 3.5, "card1": null, "V9": 2}',)], "body string")
    row = serving.parse_requests(df, expected=["V9", "V8"]).first()
    assert row["TransactionAmt"] == 3.5 and row["card1"] is None
    assert row["C1"] == 1.0 and row["D2"] is None and row["V9"] == 2.0 and row["V8"] is None


@pytest.mark.parametrize("body,amt,c1", [
    ("{}", 68.5, 1.0), (" { } ", 68.5, 1.0), ('{"C1": null}', 68.5, None), ('  {"C1": "2.5", "x": {"C1": 7}}', 68.5, 2.5),
    ('{"TransactionAmt": 1e3}', 1000.0, 1.0),
])
def test_request_bodies(spark, body, amt, c1):
    row = serving.parse_requests(spark.createDataFrame([(body,)], "body string")).first()
    assert (row["TransactionAmt"], row["C1"]) == (amt, c1)
