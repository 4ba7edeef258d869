"""Queries: models, calibration, resampling, attribution, the whole pipeline.

Fitted models are not SQL; their queries are checked by invariants in the tests.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import r6
from riskweave.operators import attribution as A
from riskweave.operators import boosting as B
from riskweave.operators import features as fe
from riskweave.operators import imbalance as I
from riskweave.operators import metrics as M
from riskweave.operators import models as ml
from riskweave.operators import serving, split
from riskweave.operators.trees import forest_of, prefix_margins
from riskweave.plans.registry import query, rounded
from riskweave.plans.views import r, sql
from riskweave.session import new_folder, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import schema as S

NUMERIC = ["TransactionAmt", "addr1", "C13", "D1", "D4", "D10", "V1"]
CATEGORIES = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]
# A small ensemble: most queries show the job, not the best score (``gbt_score`` trains ``JOB_PARAMS``). The
# search ranges of the job itself are ``models.SEARCH_SPACE``, its number of trials ``models.MAX_TRIALS``.
PARAMS = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3}
# Enough trees that the stop on validation AUC acts.
LONG_PARAMS = {"n_estimators": 96, "max_depth": 3, "learning_rate": 0.3}
LONG_PATIENCE = 20
# The job itself: as many trees as the search ranges allow, each on all training rows and columns, until
# the stop on validation AUC.
JOB_PARAMS = {"n_estimators": 2000, "max_depth": 6, "learning_rate": 0.05, "min_child_weight": 5}
JOB_PATIENCE = 100
SECOND_PARAMS = {"n_estimators": 8, "max_depth": 2, "learning_rate": 0.2}
VERSION = "m1"


def logistic(train: DataFrame) -> ml.LinearModel:
    return ml.fit_logistic(train, NUMERIC, CATEGORIES, max_iter=25)


def scores(df: DataFrame) -> DataFrame:
    return df.select(S.KEY, F.col(S.LABEL).alias("y"), F.col("probability").alias("score"))


@query("lr_score")
def lr_score(spark: SparkSession, d: str) -> DataFrame:
    df = split.temporal_split(stored(fx.learn(spark, d)))
    model = logistic(df.filter(F.col("split") == "train"))
    return rounded(scores(model.score(df.filter(F.col("split") == "test"))))


@query("lr_eval")
def lr_eval(spark: SparkSession, d: str) -> DataFrame:
    """Test metrics of the baseline, with the mean and deviation over time-series folds."""
    df = split.temporal_split(stored(fx.learn(spark, d)))
    train = df.filter(F.col("split") == "train")
    scored = scores(logistic(train).score(df.filter(F.col("split") == "test")))
    bundle = M.risk_metrics(scored, "class_weight", train.count())
    folds = ml.cross_validate(split.ts_folds(train, 3), 3, logistic)
    return rounded(bundle.crossJoin(F.broadcast(ml.cv_summary(folds))))  # one row each


class Trained:
    """Splits, fitted features and a fitted ensemble on the learnable view."""

    def __init__(self, spark: SparkSession, d: str, params: dict = PARAMS, patience: int = ml.PATIENCE):
        self.learnt = stored(fx.learn(spark, d))
        # Written with their split: fitting passes over the training rows often.
        self.rows = stored(split.prepare_splits(self.learnt))
        self.engineer = fe.without_encoding().fit(self.part("train"))
        # Written once: training, validation and scoring all read it.
        self.data = stored(self.engineer.transform(self.rows))
        self.features = fe.feature_columns(self.data)
        train, val = (self.data.filter(F.col("split") == s) for s in ("train", "val"))
        self.model = ml.fit_boosted(train, val, self.features, params, patience=patience)

    def part(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("split") == name)

    def scored(self, name: str) -> DataFrame:
        return self.model.score(self.data.filter(F.col("split") == name))


@query("gbt_score")
def gbt_score(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the test rows from the whole ensemble of the job."""
    return rounded(scores(Trained(spark, d, JOB_PARAMS, JOB_PATIENCE).scored("test")))


@query("platt_score")
def platt_score(spark: SparkSession, d: str) -> DataFrame:
    t = Trained(spark, d)
    platt = ml.fit_platt(t.scored("val"), "margin")
    out = t.scored("test").withColumn("calibrated", platt.apply(F.col("margin")))
    return rounded(
        out.select(S.KEY, F.col(S.LABEL).alias("y"), F.col("probability").alias("score"), "calibrated")
    )


@query("tree_attribution")
def tree_attribution(spark: SparkSession, d: str) -> DataFrame:
    t = Trained(spark, d)
    test = t.data.filter(F.col("split") == "test")
    return rounded(A.tree_attribution(test, S.KEY, t.features, t.model.model))


@query("boost_prefixes")
def boost_prefixes(spark: SparkSession, d: str) -> DataFrame:
    """Validation AUC of every prefix of the ensemble that was trained, and the one kept."""
    m = Trained(spark, d, LONG_PARAMS, LONG_PATIENCE).model
    rows = [(int(p), float(a), p == m.best_iteration) for p, a in m.history]
    return rounded(spark.createDataFrame(rows, "prefix int, auc_roc double, kept boolean"))


@query("topk_tree_attribution")
def topk_tree_attribution(spark: SparkSession, d: str) -> DataFrame:
    """The three features that move each test row's margin most, in the fitted ensemble."""
    t = Trained(spark, d)
    test = t.data.filter(F.col("split") == "test")
    wide = A.tree_attribution(test, S.KEY, t.features, t.model.model)
    return rounded(A.top_parts(wide, S.KEY, {f: f for f in t.features}))


@query("topk_logistic_attribution")
def topk_logistic_attribution(spark: SparkSession, d: str) -> DataFrame:
    df = split.temporal_split(stored(fx.learn(spark, d)))
    model = logistic(df.filter(F.col("split") == "train"))
    wide = model.attribution(df.filter(F.col("split") == "test"), S.KEY)
    return rounded(A.top_parts(wide, S.KEY, {f: f"part_{f}" for f in [*NUMERIC, *CATEGORIES]}))


TEST_ROWS = "(select count(*) from ranked where rk >= floor(total * 0.75))"
CHECKED = {
    "boosted_parts_add_up": TEST_ROWS, "boosted_top_parts_are_the_largest": f"3 * {TEST_ROWS}",
    "logistic_parts_add_up": TEST_ROWS, "platt_gradient_is_zero": "cast(2 as bigint)",
    "prefixes_all_judged": "cast(6 as bigint)", "batch_log_follows_the_trees": "(select count(*) from txn)",
}


@query(
    "model_checks",
    sql(" union all ".join(
        f"select '{c}' as check_name, {n} as n_rows, cast(0 as bigint) as violations" for c, n in CHECKED.items())),
)
def model_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every fitted model, row by row: rows looked at and violations."""
    t = Trained(spark, d)
    test = stored(t.scored("test"))
    forest = forest_of(t.model.model)
    base = A.expected_margin(forest)
    parts = stored(A.tree_attribution(t.data.filter(F.col("split") == "test"), S.KEY, t.features, t.model.model))
    total = sum((F.col(f"`{f}`") for f in t.features), F.lit(base))
    added = parts.select(S.KEY, total.alias("sum")).join(test.select(S.KEY, "margin"), S.KEY)
    boosted = F.abs(F.col("sum") - F.col("margin")) > 1e-9
    # Every part ranked by a window, against the three of each row that were picked inside the row.
    size = Window.partitionBy(S.KEY).orderBy(F.desc(F.abs(r6(F.col("value")))), "feature")
    ranked = A.to_long(parts, S.KEY, t.features).withColumn("rank", F.row_number().over(size)).filter("rank <= 3")
    top = A.top_parts(parts, S.KEY, {f: f for f in t.features}).select(S.KEY, "rank", F.struct("feature", "value").alias("picked"))
    both = ranked.select(S.KEY, "rank", F.struct("feature", r6(F.col("value")).alias("value")).alias("want")).join(top, [S.KEY, "rank"], "full")

    df = split.temporal_split(t.learnt)
    linear = logistic(df.filter(F.col("split") == "train")).attribution(df.filter(F.col("split") == "test"), S.KEY)
    names = [c for c in linear.columns if c.startswith("part_")]
    whole = sum((F.col(c) for c in names), F.col("base"))

    # At the best slope and intercept, calibrated scores differ from the smoothed targets by nothing
    # on average, and by nothing that goes with the margin.
    val = stored(t.scored("val"))
    platt = ml.fit_platt(val, "margin")
    n = val.agg(F.sum(F.col(S.LABEL).cast("long")).alias("pos"), F.count(F.lit(1)).alias("all")).first()
    target = F.when(F.col(S.LABEL) == 1, (n["pos"] + 1) / (n["pos"] + 2)).otherwise(1 / (n["all"] - n["pos"] + 2))
    gap = platt.apply(F.col("margin")) - target
    slopes = val.agg(F.array(F.avg(gap), F.avg(gap * F.col("margin"))).alias("g"))
    calibrated = slopes.select(F.explode("g").alias("g")).select((F.abs("g") > 1e-5).alias("bad"))

    history = spark.createDataFrame([(p, float(a)) for p, a in t.model.history], "prefix int, auc double")
    best = max(a for _, a in t.model.history)
    kept = F.lit(t.model.best_iteration)
    judged = history.select(((F.col("prefix") < kept) & (F.col("auc") >= best) | (F.col("prefix") == kept) & (F.col("auc") < best)).alias("bad"))

    # The log against the margins that a walk through the node arrays gives.
    log = batch_score(spark, d)
    shaped = fe.align_features(t.engineer.transform(fx.txn(spark, d)), t.features, keep=[S.KEY])
    walked = prefix_margins(shaped, [S.KEY], t.features, forest)
    walked = walked.select(serving.prediction_id(VERSION), (1 / (1 + F.exp(-2 * F.element_at("margins", -1)))).alias("p"))
    near = F.abs(F.col("fraud_probability") - F.col("p")) <= 1e-6
    decided = F.col("prediction") == (F.col("fraud_probability") >= 0.5).cast("int")
    wrong = ~F.coalesce(near & decided, F.lit(False))
    checks = [
        added.select(boosted.alias("bad")),
        both.select((~F.col("want").eqNullSafe(F.col("picked"))).alias("bad")),
        linear.select((F.abs(whole - F.col("margin")) > 1e-9).alias("bad")),
        calibrated, judged, log.join(walked, "prediction_id", "full").select(wrong.alias("bad")),
    ]
    out = None
    for name, rows in zip(CHECKED, checks, strict=True):
        row = rows.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if("bad").alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


@query("batch_score")
def batch_score(spark: SparkSession, d: str) -> DataFrame:
    """Engineer, align, score, decide: one prediction-log row per transaction."""
    t = Trained(spark, d)
    rows = t.engineer.transform(fx.txn(spark, d))
    aligned = fe.align_features(rows, t.features, keep=[S.KEY])
    scored = t.model.score(aligned)
    stamp = F.timestamp_seconds(F.col(S.TIME) + F.lit(fx.EPOCH_OFFSET))
    return serving.log_rows(scored.withColumn("ts", stamp), 0.5, VERSION, "ts")


@query("ablation_runs")
def ablation_runs(spark: SparkSession, d: str) -> DataFrame:
    """Raw numbers, with engineered features, and with encodings on top: one run each."""
    rows = split.prepare_splits(stored(fx.learn(spark, d)))
    is_train = F.col("split") == "train"
    data = stored(fe.FeatureEngineer().fit(rows.filter(is_train)).transform(rows, is_train))
    full = fe.feature_columns(data)
    raw = [c for c in full if c in rows.columns]
    sets = {
        "run_a_raw": raw,
        "run_b_engineered": [c for c in full if not c.endswith("_te")],
        "run_c_encoded": full,
    }
    return rounded(ml.ablation(data, sets, PARAMS))


# --- boosting on bins ---------------------------------------------------------------------------

STEPS = ["addr1", "C13", "D1", "D4"]  # columns of few values: a bin holds one value
LEAF = {"reg_alpha": 0.5, "reg_lambda": 2.0, "min_child_samples": 5}
BINNED = {**LEAF, "n_estimators": 6, "max_depth": 4, "num_leaves": 7, "learning_rate": 0.3, "subsample": 0.8,
          "colsample_bytree": 0.75}


def _soft(g: str, h: str) -> str:
    size = f"greatest(abs({g}) / 16777216.0::double - {LEAF['reg_alpha']}, 0.0)"
    return f"({size} * {size} / ({h} / 16777216.0::double + {LEAF['reg_lambda']}))"


def _leaf(g: str, h: str) -> str:
    size = f"greatest(abs({g}) / 16777216.0::double - {LEAF['reg_alpha']}, 0.0)"
    return f"(-sign({g}) * {size} / ({h} / 16777216.0::double + {LEAF['reg_lambda']}) * 0.3)"


FIRST_SPLIT = f"""rate as (select avg(isFraud) as p from learn),
base as (select 1 / (1 + exp(-ln(p / (1 - p)))) as p from rate),
sums as (select f, v, sum(cast(round_even((p - isFraud) * 16777216.0, 0) as bigint)) as g,
    sum(cast(round_even(p * (1 - p) * 16777216.0, 0) as bigint)) as h, count(*) as n
  from (select * from ({' union all '.join(f"select {j} as f, {c} as v, isFraud from learn" for j, c in enumerate(STEPS))}))
  cross join base group by f, v),
upto as (select f, v, {', '.join(f"cast(sum({c}) over (partition by f order by v) as bigint) as u{c}" for c in 'ghn')}
  from sums where v is not null),
whole as (select f, {', '.join(f"cast(sum({c}) as bigint) as a{c}, cast(coalesce(sum({c}) filter (where v is null), 0) as bigint) as m{c}" for c in 'ghn')}
  from sums group by f),
ways as (select f, v, m, {', '.join(f"u{c} + m * m{c} as l{c}, a{c} - u{c} - m * m{c} as r{c}, a{c}" for c in 'ghn')}, mn
  from upto join whole using (f) cross join (select unnest([0, 1]) as m)),
gains as (select *, floor(0.5 * ({_soft('lg', 'lh')} + {_soft('rg', 'rh')} - {_soft('ag', 'ah')}) * 1e9 + 0.5) / 1e9 as gain
  from ways where least(ln, rn) >= {LEAF['min_child_samples']} and (m = 0 or mn > 0))"""


@query(
    "boost_first_split",
    sql(f"""select ({STEPS!r})[f + 1] as feature, v as threshold, m = 1 as missing_left, ln as left_rows, rn as right_rows,
      {r(_leaf('lg', 'lh'))} as left_value, {r(_leaf('rg', 'rh'))} as right_value
      from gains where gain > 0 order by gain desc, f, v, m limit 1""", FIRST_SPLIT),
)
def boost_first_split(spark: SparkSession, d: str) -> DataFrame:
    """The split that a first tree of two leaves makes of all rows, penalties and missing values included."""
    rows = stored(fx.learn(spark, d).select(S.KEY, S.LABEL, *STEPS))
    model = B.boost(rows, rows, STEPS, {**LEAF, "n_estimators": 1, "max_depth": 1, "learning_rate": 0.3})
    out = []
    for tree in model.trees:
        f, b, missing_left, left, right, _, _ = tree[0]
        if f >= 0:
            top = max(model.edges[f][:-1], default=0.0)
            cut = model.edges[f][b] if b < len(model.edges[f]) - 1 else top
            out.append((STEPS[f], cut, bool(missing_left), tree[left][6], tree[right][6], tree[left][5], tree[right][5]))
    return rounded(spark.createDataFrame(
        out, "feature string, threshold double, missing_left boolean, left_rows long, right_rows long, left_value double, right_value double"))


TRAIN_ROWS = "(select count(*) from learn where TransactionID % 4 <> 0)"
HELD_ROWS = "(select count(*) from learn where TransactionID % 4 = 0)"
RESUMED = {
    "first_trees_stay": "cast(3 as bigint)", "same_trees_as_in_one_run": "cast(6 as bigint)",
    "prefixes_judged_on_raw_values": "cast(6 as bigint)", "parts_add_up": HELD_ROWS, "leaves_hold_the_sampled_rows": TRAIN_ROWS,
}


@query(
    "boost_resumed",
    sql(" union all ".join(
        f"select '{c}' as check_name, {n} as n_rows, cast(0 as bigint) as violations" for c, n in RESUMED.items())),
)
def boost_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Three trees, saved, read and gone on with to six, beside six in one run: what must hold of them."""
    rows = stored(fx.learn(spark, d).select(S.KEY, S.LABEL, *NUMERIC))
    train, held = rows.filter(F.col(S.KEY) % 4 != 0), rows.filter(F.col(S.KEY) % 4 == 0)
    part = B.boost(train, held, NUMERIC, {**BINNED, "n_estimators": 3}, block=3)
    path = new_folder(spark, "ensemble")
    part.save(path)
    on = B.boost(train, held, NUMERIC, BINNED, block=3, start=B.Ensemble.load(spark, path))
    whole = B.boost(train, held, NUMERIC, BINNED, block=6)

    def compared(name: str, pairs: list[tuple]) -> DataFrame:
        return spark.createDataFrame([(name, len(pairs), sum(a != b for a, b in pairs))], "check_name string, n_rows long, violations long")

    # The AUC once more, of margins walked over the raw values instead of the bins.
    judged = []
    for n, auc in on.history:
        scored = replace(on, best=n).score(held).select(F.col(S.LABEL).alias("y"), F.col("margin").alias("score"))
        judged.append((True, abs(M.roc_auc(M.score_curve(scored)).first()["auc_roc"] - auc) < 1e-9))
    forest = on.forest()
    parts = A.tree_attribution(held, S.KEY, NUMERIC, forest)
    total = sum((F.col(c) for c in NUMERIC), F.lit(on.base + A.expected_margin(forest)))
    both = parts.select(S.KEY, total.alias("total")).join(on.score(held).select(S.KEY, "margin"), S.KEY)
    wrong = F.count_if(F.abs(F.col("total") - F.col("margin")) > 1e-9)
    # Each leaf's rows are counted while a tree grows; the drawn rows, counted apart, must be as many.
    counts = [sum(n[6] for n in t if n[0] < 0) for t in on.trees]
    drawn = [F.count_if(B.is_drawn(S.KEY, i, on.settings)) for i in range(len(counts))]
    n_train, *seen = train.agg(F.count(F.lit(1)), *drawn).first()
    short = sum(a != b for a, b in zip(seen, counts))
    out = [
        compared("first_trees_stay", list(zip(part.trees, on.trees))),
        compared("same_trees_as_in_one_run", list(zip(on.trees, whole.trees))),
        compared("prefixes_judged_on_raw_values", judged),
        both.agg(F.lit("parts_add_up").alias("check_name"), F.count(F.lit(1)).alias("n_rows"), wrong.alias("violations")),
        spark.createDataFrame([("leaves_hold_the_sampled_rows", n_train, short)], "check_name string, n_rows long, violations long"),
    ]
    whole_table = out[0]
    for one in out[1:]:
        whole_table = whole_table.unionByName(one)
    return whole_table


SMALL_SPACE = [
    ("max_depth", "int", 2, 3),
    ("learning_rate", "log", 0.05, 0.3),
    ("min_child_weight", "int", 1, 20),
    ("subsample", "float", 0.6, 1.1),  # more than all rows cannot work: such trials are infeasible
    ("scale_pos_weight", "float", 1.0, 10.0),
    ("n_estimators", "int", 2, 4),
]


@query("search_trials")
def search_trials(spark: SparkSession, d: str) -> DataFrame:
    """Three random trials and three that the surrogate proposes, judged on validation rows."""
    rows = split.prepare_splits(stored(fx.learn(spark, d)))
    eng = fe.without_encoding().fit(rows.filter(F.col("split") == "train"))
    data = stored(eng.transform(rows))
    features = fe.feature_columns(data)
    train, val = (data.filter(F.col("split") == s) for s in ("train", "val"))

    def objective(params: dict) -> float:
        m = ml.fit_boosted(train, val, features, params, weight=params["scale_pos_weight"])
        return M.average_precision(M.score_curve(scores(m.score(val)))).first()[0]

    out = ml.run_search(spark, objective, 6, 42, SMALL_SPACE, starts=3, path=new_folder(spark, "trials"))
    return rounded(out.select("trial", "state", "reason", "auc_pr",
                              F.to_json("params").alias("params")))


@query("champion_report")
def champion_report(spark: SparkSession, d: str) -> DataFrame:
    """Split, engineer, train two candidates, choose on validation rows, measure, explain,
    calibrate: the report as long rows."""
    t = Trained(spark, d)
    train, val = (t.data.filter(F.col("split") == s) for s in ("train", "val"))
    models = {"first": t.model, "second": ml.fit_boosted(train, val, t.features, SECOND_PARAMS)}
    won, runs = ml.choose({name: scores(m.score(val)) for name, m in models.items()})
    t.model = models[won]
    test = t.scored("test")
    n_train = t.part("train").count()
    bundle = M.risk_metrics(scores(test), "class_weight", n_train)
    platt = ml.fit_platt(t.scored("val"), "margin")
    calibrated = test.withColumn("probability", platt.apply(F.col("margin")))
    after = M.risk_metrics(scores(calibrated), "class_weight", n_train)
    names = ["auc_pr", "auc_roc", "f1", "f2", "precision", "recall", "ks_statistic", "threshold"]

    def long(df: DataFrame, section: str) -> DataFrame:
        entries = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]
        return df.select(F.lit(section).alias("section"), F.inline(F.array(*entries)))

    attr = A.tree_attribution(
        t.data.filter(F.col("split") == "test"), S.KEY, t.features, t.model.model
    )
    top = A.ranked_importance(A.to_long(attr, S.KEY, t.features), top=10)
    curve = M.reliability_curve(scores(calibrated))
    best = spark.createDataFrame(
        [("training", "best_iteration", float(t.model.best_iteration))],
        "section string, name string, value double",
    )
    return rounded(
        long(bundle, "test")
        .unionByName(long(after, "calibrated"))
        .unionByName(top.select(F.lit("importance").alias("section"), F.col("feature").alias("name"),
                                F.col("importance").alias("value")))
        .unionByName(curve.select(F.lit("reliability").alias("section"),
                                  F.concat(F.lit("bin_"), F.col("bin")).alias("name"),
                                  F.col("positive_share").alias("value")))
        .unionByName(best)
        .unionByName(runs.select(F.lit("candidates").alias("section"), F.col("run_name").alias("name"),
                                 F.col("auc_pr").alias("value")))
    )


# --- resampling ---------------------------------------------------------------------------------

NEAR = ["TransactionAmt", "D4", "D10"]


def _dense(spark: SparkSession, d: str) -> DataFrame:
    df = fx.learn(spark, d)
    filled = [F.coalesce(c, F.lit(0.0)).alias(c) for c in NEAR]
    return df.select(S.KEY, *filled, S.LABEL)


MINORITY = f"""mi as (select TransactionID, {', '.join(f'coalesce({c}, 0) as {c}' for c in NEAR)}
  from learn where isFraud = 1),
knn as (select * from (
  select *, row_number() over (partition by TransactionID order by d2, neighbour) as rank from (
    select a.TransactionID, b.TransactionID as neighbour,
      {' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in NEAR)} as d2,
      {', '.join(f'b.{c} as n_{c}' for c in NEAR)}
    from mi a join mi b on a.TransactionID <> b.TransactionID)) where rank <= 5)"""


@query(
    "smote_knn",
    sql(f"select TransactionID, cast(rank as int) as rank, neighbour, {r('sqrt(d2)')} as distance from knn", MINORITY),
)
def smote_knn(spark: SparkSession, d: str) -> DataFrame:
    minority = _dense(spark, d).filter(F.col(S.LABEL) == 1)
    return rounded(I.nearest(minority, S.KEY, NEAR, 5).drop("neighbour_row"))


# Forty columns: remainders of the three by as many numbers, so that no column follows from another.
WIDE = [f"w{i}" for i in range(40)]
WIDE_SQL = [f"(floor({NEAR[i % 3]} * 7) * {i + 3}) % {29 + 2 * i}" for i in range(40)]


@query(
    "smote_knn_wide",
    sql(f"""select TransactionID, cast(rank as int) as rank, neighbour, {r('sqrt(d2)')} as distance from (
      select *, row_number() over (partition by TransactionID order by d2, neighbour) as rank from (
        select a.TransactionID, b.TransactionID as neighbour, {' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in WIDE)} as d2
        from wide a join wide b on a.TransactionID <> b.TransactionID)) where rank <= 5""",
        MINORITY + ", wide as (select TransactionID, " + ", ".join(f"{e} as {c}" for c, e in zip(WIDE, WIDE_SQL)) + " from mi)"),
)
def smote_knn_wide(spark: SparkSession, d: str) -> DataFrame:
    """The neighbour search in many columns, where boxes prune little."""
    minority = _dense(spark, d).filter(F.col(S.LABEL) == 1)
    wide = minority.select(S.KEY, *[F.expr(e).alias(c) for c, e in zip(WIDE, WIDE_SQL)])
    return rounded(I.nearest(stored(wide, "wide"), S.KEY, WIDE, 5).drop("neighbour_row"))


def _unit(seed: int) -> str:
    return (f"(cast('0x' || substring(md5(concat(cast(TransactionID as string), '#', cast(copy as string), '|{seed}')), 1, 12) "
            "as bigint) / 281474976710656.0::double)")


@query(
    "smote",
    sql(f"""select TransactionID, {', '.join(f'{r(c)} as {c}' for c in NEAR)}, isFraud from (
      select TransactionID, {', '.join(f'coalesce({c}, 0) as {c}' for c in NEAR)}, isFraud from learn
      union all
      select null, {', '.join(f'p.{c} + p.gap * (k.n_{c} - p.{c})' for c in NEAR)}, 1
      from picks p join knn k on p.TransactionID = k.TransactionID and p.rank = k.rank)""",
        MINORITY + f""", n as (select count(*) filter (where isFraud = 1) as n1,
        cast(floor(count(*) filter (where isFraud = 0) * 0.5) as bigint) - count(*) filter (where isFraud = 1) as wanted from learn),
      copies as (select mi.*, wanted // n1 + case when row_number() over (order by md5(concat(cast(TransactionID as string), '|42')))
        <= wanted % n1 then 1 else 0 end as c from mi cross join n),
      picks as (select *, cast(floor({_unit(42)} * 5) + 1 as bigint) as rank, {_unit(43)} as gap
        from (select *, unnest(range(1, c + 1)) as copy from copies))"""),
)
def smote(spark: SparkSession, d: str) -> DataFrame:
    return rounded(I.smote(_dense(spark, d), NEAR, 0.5, train_only=True))

