import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import attribution as A
from riskweave.operators import metrics as M
from riskweave.operators import models as ml
from riskweave.operators import split
from riskweave.operators.trees import Forest, forest_of, prefix_margins
from riskweave.plans import modelling as P
from riskweave.sources import fixtures as fx


@pytest.fixture(scope="module")
def trained(spark, sf):
    return P.Trained(spark, sf)


def ap(df):
    return M.average_precision(M.score_curve(P.scores(df))).first()[0]


def test_boosted_scores(trained):
    out = trained.scored("test")
    lo, hi, n = out.agg(F.min("probability"), F.max("probability"), F.count("*")).first()
    assert 0 <= lo <= hi <= 1 and n == 250
    base = out.agg(F.avg("isFraud")).first()[0]
    assert ap(out) > 3 * base


def test_prefix_history(trained, spark):
    m = trained.model
    assert [h[0] for h in m.history] == [1, 2, 3, 4, 5, 6]
    assert m.best_iteration == max(m.history, key=lambda h: (h[1], -h[0]))[0]
    assert len(m.model.trees) == m.best_iteration


def test_every_prefix_is_judged_exactly(trained):
    """AUC of each prefix by counting pairs of the validation rows."""
    m = trained.model
    val = trained.data.filter("split = 'val'")
    rows = prefix_margins(val, ["isFraud"], m.features, forest_of(m.model)).collect()
    y = np.array([r.isFraud for r in rows])
    for p in range(m.best_iteration):
        s = np.array([r.margins[p] for r in rows])
        diff = s[y == 1][:, None] - s[y == 0][None, :]
        assert dict(m.history)[p + 1] == pytest.approx(((diff > 0) + 0.5 * (diff == 0)).mean())


def test_stop_after_patience(spark, sf):
    t = P.Trained(spark, sf, {"n_estimators": 80, "max_depth": 2, "learning_rate": 0.5}, patience=8)
    m = t.model
    best, stopped = ml.stop_at(m.history, 8)
    assert m.best_iteration == best == len(m.model.trees)
    assert [p for p, _ in m.history] == list(range(1, len(m.history) + 1))
    assert len(m.history) == (64 if stopped else 80)
    assert ml.stop_at([(1, 0.5), (2, 0.7), (3, 0.6), (4, 0.7), (5, 0.9)], 2) == (2, True)
    assert ml.stop_at([(1, 0.5), (2, 0.7), (3, 0.6)], 2) == (2, False)


def test_a_longer_run_begins_with_the_same_trees(trained):
    val = trained.data.filter("split = 'val'")
    train = trained.data.filter("split = 'train'")
    runs = [
        ml.fit_boosted(train, val, trained.features, {**P.PARAMS, "n_estimators": n, "subsample": 0.7}, patience=99)
        for n in (3, 5)
    ]
    assert runs[1].history[:3] == runs[0].history


def test_arrays_score_like_the_model(trained):
    m = trained.model
    test = trained.data.filter("split = 'test'")
    got = prefix_margins(test, ["TransactionID"], m.features, forest_of(m.model))
    both = got.join(m.score(test).select("TransactionID", "margin"), "TransactionID").collect()
    assert len(both) == 250 and max(abs(r.margins[-1] - r.margin) for r in both) < 1e-12


def test_top_parts_are_the_largest(trained):
    test = trained.data.filter("split = 'test'")
    wide = {r.TransactionID: r for r in A.tree_attribution(test, "TransactionID", trained.features, trained.model.model).collect()}
    parts = {f: f for f in trained.features}
    frame = trained.data.sparkSession.createDataFrame(list(wide.values()))
    for r in A.top_parts(frame, "TransactionID", parts).collect():
        sizes = sorted((round(abs(wide[r.TransactionID][f]), 6) for f in trained.features), reverse=True)
        assert abs(r.value) == pytest.approx(sizes[r["rank"] - 1], abs=2e-6)


def test_platt_keeps_the_order(trained):
    platt = ml.fit_platt(trained.scored("val"), "margin")
    test = trained.scored("test")
    cal = test.withColumn("probability", platt.apply(F.col("margin")))
    assert platt.slope > 0
    assert ap(cal) == pytest.approx(ap(test))


def test_tree_attributions_sum_to_the_margin(trained):
    m = trained.model
    rows = m.score(trained.data.filter("split = 'test'")).select("TransactionID", "margin")
    attr = A.tree_attribution(trained.data.filter("split = 'test'"), "TransactionID", m.features, m.model)
    base = A.expected_margin(forest_of(m.model))
    total = sum(F.col(f"`{f}`") for f in m.features)
    both = attr.select("TransactionID", total.alias("s")).join(rows, "TransactionID").collect()
    assert len(both) == 250
    assert max(abs(base + r["s"] - r["margin"]) for r in both) < 1e-9


def random_forest(rng, trees, depth, features, full=False):
    """Trees with random splits, features that repeat on a path, and shares of covering rows."""
    nodes, roots = [], []

    def grow(d, rows):
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, rng.normal(), rows])
        if d and rows >= 2 and (full or rng.random() < 0.85):
            share = rng.integers(1, rows) if rows > 2 else 1
            nodes[at][:2] = int(rng.integers(0, features)), rng.normal()
            nodes[at][2] = grow(d - 1, float(share))
            nodes[at][3] = grow(d - 1, float(rows - share))
        return at

    for _ in range(trees):
        roots.append(grow(depth, 10.0**6 if full else 1000.0))
    f, t, left, right, value, cover = zip(*nodes, strict=True)
    return Forest(*(np.array(c) for c in (f, t, left, right, value, cover)), np.array(roots))


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 8])
def test_path_shapley_against_all_coalitions(depth):
    rng = np.random.default_rng(depth)
    n = 4
    forest = random_forest(rng, 3, depth, n)
    x = rng.normal(0, 1.5, (12, n))
    x[0, 1] = np.nan

    def value(row, coalition):
        def below(node):
            f = forest.feature[node]
            if f < 0:
                return forest.value[node]
            left, right = forest.left[node], forest.right[node]
            if f in coalition:
                return below(left if row[f] <= forest.threshold[node] else right)
            return (forest.cover[left] * below(left) + forest.cover[right] * below(right)) / forest.cover[node]

        return sum(below(root) for root in forest.roots)

    got = A.path_shapley(x, forest)
    assert A.expected_margin(forest) == pytest.approx(value(x[0], set()))
    for row, phi in zip(x, got, strict=True):
        for f in range(n):
            rest = [g for g in range(n) if g != f]
            want = sum(
                math.factorial(len(c)) * math.factorial(n - 1 - len(c)) / math.factorial(n) * (value(row, {*c, f}) - value(row, set(c)))
                for k in range(n) for c in itertools.combinations(rest, k)
            )
            assert phi[f] == pytest.approx(want, abs=1e-9)


def test_two_hundred_deep_trees_on_ten_thousand_rows():
    rng = np.random.default_rng(1)
    forest = random_forest(rng, 200, 8, 40, full=True)
    x = rng.normal(0, 1.5, (10_000, 40))
    start = time.process_time()
    got = A.path_shapley(x, forest)
    assert time.process_time() - start < 60
    margin = forest.margins(x[:500]).sum(axis=1)
    assert np.allclose(got[:500].sum(axis=1) + A.expected_margin(forest), margin, atol=1e-8)


def test_parameter_mapping():
    got = ml.map_parameters({"n_estimators": 9, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8,
                             "colsample_bytree": 0.5, "min_child_weight": 5, "num_leaves": 31, "reg_alpha": 1,
                             "scale_pos_weight": 27})
    assert got == {"maxIter": 9, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8,
                   "featureSubsetStrategy": "0.5", "minInstancesPerNode": 5}


def test_draws_stay_in_range_and_repeat(spark):
    a = ml.draw_trials(spark, 20, 1)
    assert a == ml.draw_trials(spark, 20, 1) != ml.draw_trials(spark, 20, 2)
    for t in a:
        for name, kind, low, high in ml.SEARCH_SPACE:
            assert low <= t[name] <= high
            assert kind != "int" or isinstance(t[name], int)


def test_failed_trial_is_recorded(spark):
    def objective(p):
        if p["a"] == 2:
            raise RuntimeError("cannot fit")
        return p["a"] / 10

    out = ml.search(spark, [{"a": 1}, {"a": 2}, {"a": 3}], objective)
    rows = {r["trial"]: r for r in out.collect()}
    assert rows[2]["state"] == "infeasible" and rows[2]["reason"] == "cannot fit" and rows[2]["auc_pr"] is None
    assert ml.best_params(out) == {"a": 3.0}


def test_failure_without_a_message_is_recorded(spark):
    def objective(p):
        raise KeyError() if p["a"] == 1 else RuntimeError("first\nsecond " + "x" * 400)

    rows = {r["trial"]: r["reason"] for r in ml.search(spark, [{"a": 1}, {"a": 2}], objective).collect()}
    assert rows == {1: "KeyError", 2: "first\nsecond " + "x" * 400}


def test_logistic_round_trip_and_unseen(spark, sf, tmp_path):
    df = split.temporal_split(fx.learn(spark, sf))
    model = P.logistic(df.filter("split = 'train'"))
    test = df.filter("split = 'test'")
    model.save(str(tmp_path / "m"))
    again = ml.LinearModel.load(spark, str(tmp_path / "m"))
    assert again.medians == model.medians and again.categories == model.categories
    a = model.score(test).orderBy("TransactionID").select("probability").collect()
    assert a == again.score(test).orderBy("TransactionID").select("probability").collect()
    odd = model.score(test.withColumn("ProductCD", F.lit("never"))).agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= odd[0] <= odd[1] <= 1
    assert ap(model.score(test)) > 0.5


def test_boosted_round_trip(trained, spark, tmp_path):
    trained.model.save(str(tmp_path / "gbt"))
    again = ml.BoostedModel.load(spark, str(tmp_path / "gbt"))
    test = trained.data.filter("split = 'test'")
    a, b = (m.score(test).orderBy("TransactionID").select("probability").collect() for m in (trained.model, again))
    assert a == b and again.best_iteration == trained.model.best_iteration


def test_ablation_runs(spark, sf):
    rows = {r["run_name"]: r for r in P.ablation_runs(spark, sf).collect()}
    assert [rows[n]["n_features"] for n in ("run_a_raw", "run_b_engineered", "run_c_encoded")] == [11, 20, 24]
    assert all(0 <= r["auc_pr"] <= 1 for r in rows.values())


def test_best_parameters_are_kept(spark, tmp_path):
    space = [("max_depth", "int", 2, 9), ("learning_rate", "log", 0.01, 0.3)]
    trials = ml.run_search(spark, lambda p: p["max_depth"] / 10, n=6, space=space)
    assert trials.count() == 6 and ml.MAX_TRIALS == 30
    best = ml.save_best(trials, str(tmp_path / "best"))
    assert ml.load_best(spark, str(tmp_path / "best")) == best
    assert best["max_depth"] == max(r.params["max_depth"] for r in trials.collect())


BOWL = [("a", "float", -2.0, 3.0), ("b", "log", 0.01, 10.0), ("c", "int", 0, 12), ("d", "float", 0.0, 1.0)]


def bowl(p):
    """Best (0) at a = 1, b = 0.5, c = 7, d = 0.2; nothing comes of d above 0.9."""
    if p["d"] > 0.9:
        raise ValueError("d is too large")
    return -((p["a"] - 1) ** 2 + (math.log(p["b"] / 0.5)) ** 2 / 4 + (p["c"] - 7) ** 2 / 30 + 3 * (p["d"] - 0.2) ** 2)


def test_guided_search_beats_draws(spark):
    best = lambda rows: max(r.auc_pr for r in rows if r.auc_pr is not None)
    draws = [best(ml.search(spark, ml.draw_trials(spark, 30, seed, BOWL), bowl).collect()) for seed in range(4)]
    for seed in range(2):
        rows = ml.run_search(spark, bowl, 30, seed, BOWL).collect()
        assert [r.trial for r in rows] == list(range(1, 31))
        assert best(rows) > 0.5 * np.mean(draws)  # scores are negative: half as far from the best
        assert {r.state for r in rows} <= {"completed", "infeasible"}


def test_trials_train_models(spark, sf):
    """Trials run in threads of their own; what can work, works."""
    rows = P.search_trials(spark, sf).collect()
    assert len(rows) == 6
    done = [r for r in rows if r.state == "completed"]
    assert len(done) >= 2 and all(0 < r.auc_pr <= 1 for r in done)
    assert all("subsampl" in r.reason for r in rows if r.state == "infeasible")


def test_a_search_goes_on_where_it_stopped(spark, tmp_path):
    calls = []

    def counted(p):
        calls.append(p)
        return bowl(p)

    path = str(tmp_path / "trials")
    first = ml.run_search(spark, counted, 8, 3, BOWL, path=path).collect()
    assert len(calls) == 8
    again = ml.run_search(spark, counted, 14, 3, BOWL, path=path).collect()
    assert len(calls) == 14 and len(again) == 14
    assert [(r.trial, r.params, r.auc_pr) for r in again[:8]] == [(r.trial, r.params, r.auc_pr) for r in first]
    only_bad = ml.run_search(spark, lambda p: 1 / 0, 5, 3, BOWL).collect()
    assert {r.state for r in only_bad} == {"infeasible"} and len({str(r.params) for r in only_bad}) == 5


def test_champion_report_chooses_on_validation(spark, sf):
    rows = {(r.section, r.name): r.value for r in P.champion_report(spark, sf).collect()}
    candidates = {n: v for (s, n), v in rows.items() if s == "candidates"}
    assert set(candidates) == {"first", "second"} and all(0 < v <= 1 for v in candidates.values())
    assert ("test", "auc_pr") in rows and ("training", "best_iteration") in rows


def test_prefix_counts_hold_every_row_once(spark, monkeypatch):
    """Margins counted in small blocks; rows without a label take no part in the AUC of a prefix."""
    from riskweave.operators import trees

    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 9, 400).astype(float), rng.random(400)
    rows = [(int(x + 4 * z > 6), float(x), float(z)) for x, z in zip(a, b)]
    train = spark.createDataFrame(rows, "isFraud int, a double, b double")
    m = ml.fit_boosted(train, train, ["a", "b"], {"n_estimators": 5, "max_depth": 2, "learning_rate": 0.3})
    valid = spark.createDataFrame([*rows, (None, 1.0, 0.5), (1, None, 0.5)], "isFraud int, a double, b double")
    forest = forest_of(m.model)
    want = [np.cumsum(forest.margins(np.array([(r[1], r[2])])), axis=1)[0] for r in rows] + [
        np.cumsum(forest.margins(np.array([(np.nan, 0.5)])), axis=1)[0]]
    y = np.array([r[0] for r in rows] + [1])
    for cells in (trees.CELLS, 50):
        monkeypatch.setattr(trees, "CELLS", cells)
        labelled = valid.filter("isFraud is not null")
        found = {}
        for r in trees.prefix_counts(labelled, "isFraud", ["a", "b"], forest).collect():
            old = found.get((r.prefix, r.score), (0, 0))
            found[r.prefix, r.score] = old[0] + r.pos, old[1] + r.neg
        plain = {}
        for margins, label in zip(want, y):
            for t, s in enumerate(margins, 1):
                old = plain.get((t, s), (0, 0))
                plain[t, s] = old[0] + label, old[1] + 1 - label
        assert found == plain
        for prefix, auc in ml.prefix_auc(m.model, ["a", "b"], valid, "isFraud"):
            s = np.array([w[prefix - 1] for w in want])
            pos, neg = s[y == 1, None], s[None, y == 0]
            assert auc == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean(), abs=1e-9)


def test_fitting_passes_read_the_split_and_do_not_make_it(spark, sf):
    t = P.Trained(spark, sf)
    shown = t.part("train")._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in shown and "Window" not in shown


def test_gbt_score_fits_the_whole_job(spark, sf, monkeypatch):
    """As many trees as a search may ask for, unless the validation rows stop them, on every training row."""
    asked = {}

    def fit(train, valid, features, params, **more):
        asked.update(params=params, rows=train.count(), **more)
        return ml.BoostedModel(list(features), None, 0)

    monkeypatch.setattr(ml, "fit_boosted", fit)
    monkeypatch.setattr(ml.BoostedModel, "score", lambda self, df: df.withColumn("probability", F.lit(0.5)))
    assert P.gbt_score(spark, sf).count() == 250
    low, high = next((low, high) for name, _, low, high in ml.SEARCH_SPACE if name == "n_estimators")
    assert low <= high == asked["params"]["n_estimators"]
    low, high = next((low, high) for name, _, low, high in ml.SEARCH_SPACE if name == "max_depth")
    assert low <= asked["params"]["max_depth"] <= high
    assert asked["patience"] >= ml.PATIENCE and asked["rows"] == 600
    assert not {"subsample", "colsample_bytree"} & set(asked["params"])


def test_rounds_in_blocks_judge_each_prefix_once(spark, monkeypatch):
    """Longer runs, judged in blocks of trees, give the history of one run judged at once."""
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 9, 300).astype(float), rng.random(300)
    noise = rng.random(300)
    rows = [(int(x + 4 * z + 3 * e > 8), float(x), float(z)) for x, z, e in zip(a, b, noise)]
    train = spark.createDataFrame(rows, "isFraud int, a double, b double")
    valid = spark.createDataFrame([*rows[::2], (None, 1.0, 0.5), (1, None, 0.5)], "isFraud int, a double, b double")
    params = {"n_estimators": 9, "max_depth": 2, "learning_rate": 0.3}
    whole = ml.fit_boosted(train, valid, ["a", "b"], params, patience=9)
    seen, real = [], ml.prefix_counts

    def counts(df, label, features, forest, first=0, last=None):
        seen.extend(range(first, min(last, len(forest.roots))))
        return real(df, label, features, forest, first, last)

    monkeypatch.setattr(ml, "prefix_counts", counts)
    monkeypatch.setattr(ml, "JUDGED_CELLS", 2 * 150)
    blocks = ml.fit_boosted(train, valid, ["a", "b"], params, patience=3, first_rounds=3)
    assert seen == list(range(len(blocks.history))) and len(seen) > 3
    assert blocks.history == whole.history[: len(blocks.history)]
