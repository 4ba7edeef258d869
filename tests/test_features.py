import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.operators import lookup
from riskweave.operators.lookup import State, lookup_join
from riskweave.operators.split import split_summary

BASE = ("TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, card4 string, "
        "card6 string, P_emaildomain string, R_emaildomain string, D1 double, D4 double, D10 double, "
        "V1 double, V2 double, isFraud int")


def small(spark, n=20, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((
            i, 86400 + 3600 * i, float(np.round(rng.uniform(1, 300), 2)), int(rng.choice([100, 200, 300])),
            str(rng.choice(["visa", "mc"])), str(rng.choice(["debit", "credit"])), "a.com",
            None if i % 3 == 0 else "b.com", None if i % 4 == 0 else float(i), float(i % 5), None if i % 5 == 0 else 2.0 * i,
            None if i % 2 == 0 else float(i), 1.5, int(rng.random() < 0.2),
        ))
    return spark.createDataFrame(rows, BASE)


def test_twelve_raw_columns_become_21(spark):
    df = small(spark)
    out = fe.FeatureEngineer().fit_transform(df)
    made = [c for c in out.columns if c not in ("TransactionID", "isFraud")]
    assert len(made) == 21 - 4 + 4  # four categories leave, four encodings come, nine are new
    assert not {"card4", "card6", "P_emaildomain", "R_emaildomain"} & set(out.columns)
    assert out.count() == 20
    enc = out.select(*[c for c in out.columns if c.endswith("_te")]).collect()
    assert all(v is not None and 0 <= v <= 1 for r in enc for v in r)


def test_key_never_becomes_a_feature(spark):
    out = fe.without_encoding().fit(small(spark)).transform(small(spark))
    assert "TransactionID" not in fe.feature_columns(out)


def test_not_fitted(spark):
    with pytest.raises(fe.NotFitted):
        fe.FeatureEngineer().transform(small(spark))


def test_leave_one_out_by_hand(spark):
    rows = [(i, 0, 1.0, 1, c, "d", "a", "b", 1.0, 1.0, 1.0, 1.0, 1.0, y)
            for i, (c, y) in enumerate(zip(["visa", "visa", "other", "other"], [1, 1, 0, 0]))]
    df = spark.createDataFrame(rows, BASE)
    out = fe.FeatureEngineer().fit_transform(df).orderBy("TransactionID").collect()
    assert [r["card4_te"] for r in out] == [1.0, 1.0, 0.0, 0.0]


def test_lone_and_unseen_categories_get_the_overall_mean(spark):
    train = spark.createDataFrame([(i, 0, 1.0, 1, c, "d", "a", "b", 1.0, 1.0, 1.0, 1.0, 1.0, y)
                                   for i, (c, y) in enumerate([("solo", 1), ("x", 0), ("x", 0), ("x", 1)])], BASE)
    eng = fe.FeatureEngineer().fit(train)
    got = {r["TransactionID"]: r["card4_te"] for r in eng.transform(train, train_rows=F.lit(True)).collect()}
    assert got[0] == 0.5
    test = train.withColumn("card4", F.lit("never seen"))
    assert {r["card4_te"] for r in eng.transform(test).collect()} == {0.5}


def test_smoothing_by_hand(spark):
    train = spark.createDataFrame([(i, 0, 1.0, 1, c, "d", "a", "b", 1.0, 1.0, 1.0, 1.0, 1.0, y)
                                   for i, (c, y) in enumerate([("v", 1), ("v", 1), ("m", 0), ("m", 0)])], BASE)
    out = fe.FeatureEngineer().fit(train).transform(train).filter("card4_te is not null").collect()
    w = 2 / 12
    assert out[0]["card4_te"] == pytest.approx(w * 1.0 + (1 - w) * 0.5)


def test_medians_come_from_training_rows_only(spark):
    train = spark.createDataFrame([(i, 0, 1.0, 1, "v", "d", "a", "b", 1.0, 1.0, 1.0, v, None, 0)
                                   for i, v in enumerate([None, 2.0, None])], BASE)
    test = spark.createDataFrame([(9, 0, 1.0, 1, "v", "d", "a", "b", 1.0, 1.0, 1.0, None, None, 0)], BASE)
    row = fe.without_encoding().fit(train).transform(test).first()
    assert row["V1"] == 2.0
    assert row["V2"] == 0.0  # nothing to take a median of


def test_norm_uses_raw_medians_on_imputed_values(spark):
    rows = [(0, 100, 10.0), (1, 100, None), (2, 100, 20.0), (3, 200, 40.0)]
    df = spark.createDataFrame([(i, 0, 1.0, c, "v", "d", "a", "b", d, 1.0, 1.0, 1.0, 1.0, 0) for i, c, d in rows], BASE)
    eng = fe.without_encoding().fit(df)
    got = {r["TransactionID"]: r["D1_card_norm"] for r in eng.transform(df).collect()}
    # median of all raw D1 is 20 (fills the gap); raw median of card 100 is 15
    assert got == {0: -5.0, 1: 5.0, 2: 5.0, 3: 0.0}
    unseen = df.withColumn("card1", F.lit(999).cast("bigint"))
    assert {r["D1_card_norm"] for r in eng.transform(unseen).collect()} == {0.0}


def test_ratio_survives_minus_one(spark):
    df = spark.createDataFrame([(0, 0, 5.0, 1, "v", "d", "a", "b", -1.0, 1.0, 1.0, 1.0, 1.0, 0)], BASE)
    assert fe.without_encoding().fit(df).transform(df).first()["amt_to_d1_ratio"] == 0.0


def test_indicators_are_off_by_default(spark):
    out = fe.FeatureEngineer().fit_transform(small(spark))
    assert not [c for c in out.columns if c.endswith("_was_missing")]
    df = small(spark)
    some = fe.missing_indicators(df, df, ["V1", "V2"], 0.05, 0.8)
    assert "V1_was_missing" in some.columns and "V2_was_missing" not in some.columns


def test_state_round_trip(spark, tmp_path):
    df = small(spark)
    eng = fe.FeatureEngineer().fit(df)
    eng.save(str(tmp_path / "state"))
    again = fe.FeatureEngineer.load(spark, str(tmp_path / "state"))
    a = eng.transform(df).orderBy("TransactionID").collect()
    assert a == again.transform(df).orderBy("TransactionID").collect()


def test_align(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "b double, extra double")
    out = fe.align_features(df, ["a", "b"])
    assert out.columns == ["a", "b"] and out.first() == (None, 1.0)


def test_lookup_beyond_the_broadcast_limit(spark):
    """Salted way: hot and NULL keys included, nothing lost, nothing doubled."""
    rows = [(i, None if i % 5 == 0 else ("hot" if i % 3 == 0 else f"k{i % 50}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, k string")
    counts = df.filter("k is not null").groupBy("k").count().withColumn("v", F.length("k"))
    state = State.of(counts, "k", "count")
    small_way = lookup_join(df, state, "id").orderBy("id").collect()
    big_way = lookup_join(df, state, "id", limit=0).orderBy("id").select("k", "id", "v").collect()
    assert [tuple(r) for r in big_way] == [(r["k"], r["id"], r["v"]) for r in small_way]
    assert 0 < state.bytes < lookup.BROADCAST_BYTES


def test_state_size_is_bytes_after_fit_and_after_load(spark, tmp_path, monkeypatch):
    """A large encoding takes the salted way, and a loaded engineer the way of the fitted one."""
    rows = [(i, f"category number {i % 400} with a long name", i % 3 % 2, 10.0 + i, i % 40) for i in range(2000)]
    df = spark.createDataFrame(rows, "TransactionID bigint, P_emaildomain string, isFraud int, TransactionAmt double, card1 bigint")
    df = df.withColumns({"TransactionDT": F.col("TransactionID") * 60, "C1": F.col("TransactionAmt") % 7, "D1": F.col("TransactionAmt") % 5})
    eng = fe.FeatureEngineer(encoded=("P_emaildomain",)).fit(df)
    eng.save(str(tmp_path / "state"))
    again = fe.FeatureEngineer.load(spark, str(tmp_path / "state"))
    texts = sum(len(f"category number {i} with a long name") for i in range(400))
    assert eng.categories["P_emaildomain"].bytes == again.categories["P_emaildomain"].bytes == texts + 400 * 24
    assert eng.groups.bytes == again.groups.bytes >= 40 * 16
    small = sorted(eng.transform(df).collect())

    def broadcasts(e):
        plan = e.transform(df)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("strategy=broadcast"), plan.count("_salt")

    assert all(broadcasts(e)[1] == 0 for e in (eng, again))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", texts)
    assert all(broadcasts(e)[1] > 0 for e in (eng, again))
    columns = eng.transform(df).columns
    assert sorted(again.transform(df).select(columns).collect()) == small


def test_null_group_is_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0), (1, 4.0)], "card1 bigint, D1 double")
    assert [tuple(r) for r in fe.group_medians(df, "card1", ["D1"]).collect()] == [(1, 3.0, 2)]


def test_split_summary(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "split string, isFraud int")
    assert {r["split"]: (r["rows"], r["label_rate"]) for r in split_summary(df).collect()} == {"a": (2, 0.5), "b": (1, 0.0)}


def test_full_width_gives_387_features(spark):
    """All 394 declared columns, all of them with gaps."""
    from riskweave.operators import quality
    from riskweave.sources import schema as S

    def value(f, i):
        number = (F.col("id") * (i + 3)) % 17
        kind = f.dataType.typeName()
        if f.name in ("TransactionID", "TransactionDT"):
            return F.col("id").cast("bigint")
        if f.name == "isFraud":
            return (F.col("id") % 9 == 0).cast("int")
        gap = (F.col("id") + i) % 5 == 0
        return F.when(~gap, number.cast(kind if kind != "long" else "bigint"))

    wide = spark.range(60).select(*[value(f, i).alias(f.name) for i, f in enumerate(S.TRANSACTION_SCHEMA)])
    out = fe.without_encoding().fit(wide).transform(wide)
    features = fe.feature_columns(out)
    assert len(features) == 387
    gate = quality.feature_gate(out, features, 387).first()
    assert gate["passed"] and gate["null_cells"] == 0
    medians = fe.column_medians(wide, ["V7", "C3", "dist2"])
    for c, m in medians.items():
        assert m == pytest.approx(np.median([r[0] for r in wide.select(c).collect() if r[0] is not None]))
