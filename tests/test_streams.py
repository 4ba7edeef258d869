"""Streams against their batch twins, late rows and restarts included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import drift, serving
from riskweave.sources import schema as S
from riskweave.streaming import jobs

UTC = dt.timezone.utc


def rows(*hours, start=0):
    t0 = dt.datetime(2024, 1, 1, tzinfo=UTC)
    return [(f"p{start + i}", t0 + dt.timedelta(hours=h), 0.6, i % 2, 0.5, 10.0 * i, "m") for i, h in enumerate(hours)]


def put(spark, folder, number, data):
    """One file per step, in order of arrival."""
    spark.createDataFrame(data, S.PREDICTION_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/step{number}")


def stream(spark, folder):
    return (spark.readStream.schema(S.PREDICTION_LOG_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(folder))


def windows(df):
    return {r["w"]["start"]: r["n"] for r in df.collect()}


def test_closed_windows_equal_the_batch_twin(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    data = [rows(1, 5, 20), rows(25, 30, start=3), rows(49, 60, 80, start=5)]
    for i, d in enumerate(data):
        put(spark, src, i, d)
    jobs.windowed_rates(stream(spark, src), out, "1 day")
    got = windows(spark.read.parquet(f"{out}/table"))
    twin = windows(serving.windowed_rate(spark.createDataFrame(sum(data, []), S.PREDICTION_LOG_SCHEMA), "1 day"))
    last = max(twin)
    assert got == {k: v for k, v in twin.items() if k != last}


def test_sliding_windows_over_restarts_equal_the_batch_twin(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rng = random.Random(6)
    steps = [sorted(rng.uniform(a, a + 9) for _ in range(40)) for a in (0, 9, 18, 40)] + [[90.5, 91]]
    data = [rows(*h, start=100 * i) for i, h in enumerate(steps)]
    for i, d in enumerate(data):
        put(spark, src, i, d)
        jobs.windowed_rates(stream(spark, src), out, "6 hours", "1 hour")
    made = {tuple(r["w"]): tuple(r)[1:] for r in spark.read.parquet(f"{out}/table").drop("until").collect()}
    twin = serving.windowed_rate(spark.createDataFrame(sum(data, []), S.PREDICTION_LOG_SCHEMA), "6 hours", "1 hour")
    last = max(r[1] for d in data for r in d) - dt.timedelta(hours=1)
    want = {tuple(r["w"]): tuple(r)[1:] for r in twin.collect() if r["w"]["end"].replace(tzinfo=UTC) <= last}
    assert made.keys() == want.keys() and len(made) > 40
    assert all(made[k] == pytest.approx(v) for k, v in want.items())


def test_percentiles_are_exact_in_windows_of_over_a_million_rows(spark):
    n = 1_200_000
    log = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 7200).alias("timestamp"),
        (F.col("id") % 5 == 0).cast("int").alias("prediction"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 1_000_003) / 10).alias("latency_ms"),
    )
    got = serving.windowed_rate(log, "24 hours", "1 hour")
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    row = got.filter("w.start = timestamp '2024-01-01 00:00:00'").first()
    import numpy as np

    i = np.arange(n)
    x = np.sort(np.where(i % 3 == 0, 7.0, i * 7919 % 1_000_003 / 10))
    assert row.n == n and row.rate == pytest.approx(0.2) and row.max_latency_ms == x[-1]
    for p, name in serving.LATENCIES.items():
        assert row[name] == x[int(n - np.floor(n - p * n)) - 1]


def test_late_row_is_dropped(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    put(spark, src, 0, rows(1, 2))
    jobs.windowed_rates(stream(spark, src), out, "1 day")
    put(spark, src, 1, rows(50, start=10))
    jobs.windowed_rates(stream(spark, src), out, "1 day")
    put(spark, src, 2, rows(3, 100, start=20))  # hour 3 arrives after its day is closed
    jobs.windowed_rates(stream(spark, src), out, "1 day")
    got = windows(spark.read.parquet(f"{out}/table"))
    assert sorted(got.values()) == [1, 2]


def test_log_holds_each_prediction_once_over_restarts(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    put(spark, src, 0, rows(1, 1.2) + rows(1, 1.2))
    jobs.log_once(stream(spark, src), out)
    put(spark, src, 1, rows(50, 70, start=10))  # two days later
    put(spark, src, 2, rows(1, 1.2, 1.4))  # two repeats and a new one
    jobs.log_once(stream(spark, src), out)
    got = spark.read.parquet(f"{out}/table")
    assert sorted(r["prediction_id"] for r in got.collect()) == ["p0", "p1", "p10", "p11", "p2"]
    assert {str(r["date"]) for r in got.collect()} == {"2024-01-01", "2024-01-03"}


def test_log_after_a_crash_between_write_and_commit(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    put(spark, src, 0, rows(1, 2))
    jobs.log_once(stream(spark, src), out)
    put(spark, src, 1, rows(1, 2, 3, 30))
    jobs.log_once(stream(spark, src), out)
    # As if the second batch had been written, but never committed.
    for f in (tmp_path / "out" / "checkpoint" / "commits").iterdir():
        if f.name.strip(".").startswith("1"):
            f.unlink()
    jobs.log_once(stream(spark, src), out)
    assert sorted(r["prediction_id"] for r in spark.read.parquet(f"{out}/table").collect()) == ["p0", "p1", "p2", "p3"]


def test_sliding_rate_drift_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    data = rows(*[h * 0.5 for h in range(600)])
    put(spark, src, 0, data)
    jobs.to_table(jobs.windowed_rate_drift(stream(spark, src), "7 days", "1 day", min_rows=10), out)
    got = {r["w"]["start"]: r["psi_score"] for r in spark.read.parquet(f"{out}/table").collect()}
    batch = drift.rate_drift(spark.createDataFrame(data, S.PREDICTION_LOG_SCHEMA),
                             [F.window("timestamp", "7 days", "1 day")], min_rows=10)
    want = {r["_k0"]["start"]: r["psi_score"] for r in batch.collect()}
    assert got and all(want[k] == pytest.approx(v) for k, v in got.items())


# --- scheduled drift checks ---------------------------------------------------------------------


def arrived(rng, days, n=150):
    """(day, x, y, prediction): x drifts with the days; some values and some predictions are missing."""
    out = []
    for day in days:
        for _ in range(n):
            x = rng.gauss(day / 10, 1)
            out.append((day, x if rng.random() > 0.1 else None, float(rng.randint(0, 3)), rng.randint(0, 1) if rng.random() > 0.2 else None))
    return out


DRIFT_SCHEMA = "day long, x double, y double, prediction int"


def test_each_drift_check_is_the_batch_check_of_its_window(spark, tmp_path):
    rng = random.Random(4)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    base = drift.fit_baselines(spark.createDataFrame(arrived(rng, range(3), 300), DRIFT_SCHEMA), ["x", "y"])
    steps = [arrived(rng, range(0, 4)), arrived(rng, range(4, 9)), arrived(rng, [2, 5, 9]), arrived(rng, [30], 20), arrived(rng, [31, 29, 24])]
    steps[2] += [(None, 1.0, 1.0, 1)]
    everything, sizes = [], []
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, DRIFT_SCHEMA).write.parquet(f"{src}/step{i}")
        stream = spark.readStream.schema(DRIFT_SCHEMA).option("recursiveFileLookup", True).parquet(src)
        jobs.drift_checks(stream, base, out, min_rows=10)  # a restart at each step
        everything += rows
        last = max(r[0] for r in everything if r[0] is not None)
        inside = spark.createDataFrame([r for r in everything if r[0] is not None and last - 7 < r[0] <= last], DRIFT_SCHEMA)
        twin = drift.drift_rows(inside, base).unionByName(drift.rate_drift(inside.filter("prediction is not null"), min_rows=10))
        got = spark.read.parquet(f"{out}/table/batch={i}")
        assert {r.as_of for r in got.collect()} == {last}
        want = {r.feature_name: r for r in twin.collect()}
        assert len(want) == 3
        for r in got.collect():
            w = want.pop(r.feature_name)
            assert (r.alert_fired, r.window_days) == (w.alert_fired, w.window_days)
            assert [r.psi_score, r.baseline_mean, r.current_mean] == pytest.approx([w.psi_score, w.baseline_mean, w.current_mean])
        assert not want
        sizes.append(spark.read.parquet(f"{out}/panes/{i}").count())
    assert sizes == [4, 7, 7, 1, 3]  # days, whatever has arrived
    assert sorted(p.name for p in (tmp_path / "out" / "panes").iterdir()) == ["3", "4"]


def test_a_drift_check_that_failed_is_made_again(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    base = drift.fit_baselines(spark.createDataFrame(arrived(rng, range(3)), DRIFT_SCHEMA), ["x"])

    def run():
        jobs.drift_checks(spark.readStream.schema(DRIFT_SCHEMA).option("recursiveFileLookup", True).parquet(src), base, out)

    first, second = arrived(rng, range(3)), arrived(rng, range(3, 5))
    spark.createDataFrame(first, DRIFT_SCHEMA).write.parquet(f"{src}/a")
    run()
    spark.createDataFrame(second, DRIFT_SCHEMA).write.parquet(f"{src}/b")
    whole = drift.pane_check

    def broken(*a, **k):
        raise RuntimeError("stopped between panes and rows")

    monkeypatch.setattr(drift, "pane_check", broken)
    with pytest.raises(Exception, match="stopped between"):
        run()
    monkeypatch.setattr(drift, "pane_check", whole)
    run()
    n = {r.day: r.x_n for r in spark.read.parquet(f"{out}/panes/1").collect()}
    want = {}
    for day, x, _, _ in first + second:
        want[day] = want.get(day, 0) + (x is not None)
    assert n == want
    assert spark.read.parquet(f"{out}/table").filter("batch = 1").count() == 2
