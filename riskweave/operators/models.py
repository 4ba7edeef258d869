"""Spark ML models: weighted logistic regression, boosted trees stopped on AUC, Platt."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import sigmoid
from riskweave.operators import metrics as M
from riskweave.operators import runs as R
from riskweave.operators.features import column_medians, impute
from riskweave.operators.imbalance import positive_weight, weight_column
from riskweave.operators.split import class_balance
from riskweave.operators.trees import Forest, first_trees, forest_of, margin_after, prefix_counts
from riskweave.session import exists, new_folder, remove, running_session
from riskweave.sources import schema as S

# --- logistic regression ---------------------------------------------------------------


@dataclass
class LinearModel:
    """Literal medians plus a fitted pipeline."""

    medians: dict[str, float]
    categories: list[str]
    pipeline: PipelineModel

    def save(self, path: str) -> None:
        """The pipeline, and next to it the medians and categories that go before it."""
        spark = running_session()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        facts = [(self.medians, self.categories)]
        spark.createDataFrame(facts, "medians map<string,double>, categories array<string>").write.mode(
            "overwrite"
        ).parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        facts = spark.read.parquet(f"{path}/facts").first()
        return cls(dict(facts["medians"]), list(facts["categories"]), PipelineModel.load(f"{path}/pipeline"))

    def attribution(self, df: DataFrame, key: str) -> DataFrame:
        """(key, margin, base, one column per input): parts that add up to the margin.

        A number has coefficient times scaled value; a category has the coefficient of its
        value; the intercept is the base.
        """
        stage = self.pipeline.stages[-1]
        weights = [float(c) for c in stage.coefficients]
        out = self.pipeline.transform(_filled(df, self.medians, self.categories))
        x = vector_to_array("features")
        parts, at = {}, 0
        for name in self.medians:
            parts[name] = x[at] * F.lit(weights[at])
            at += 1
        indexer = next(s for s in self.pipeline.stages if isinstance(s, StringIndexerModel))
        for name, values in zip(self.categories, indexer.labelsArray):
            # One slot a known value; an unseen one has none.
            slots = [x[at + i] * F.lit(weights[at + i]) for i in range(len(values))]
            parts[name] = sum(slots, F.lit(0.0))
            at += len(values)
        return out.select(
            key, vector_to_array("rawPrediction")[1].alias("margin"), F.lit(float(stage.intercept)).alias("base"),
            *[e.alias(f"part_{n}") for n, e in parts.items()],
        )

    def score(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(_filled(df, self.medians, self.categories))
        p = vector_to_array("probability")[1]
        return out.withColumn("p1", p).drop(
            "raw", "features", "rawPrediction", "probability", "prediction", "num", "num_scaled",
            *[f"{c}_ix" for c in self.categories], *[f"{c}_oh" for c in self.categories],
        ).withColumnRenamed("p1", "probability")


def _filled(df: DataFrame, medians: dict[str, float], categories: Sequence[str]) -> DataFrame:
    return impute(df, medians).fillna("missing", subset=list(categories))


def fit_logistic(
    train: DataFrame, numeric: Sequence[str], categories: Sequence[str], label: str = S.LABEL,
    max_iter: int = 50,
) -> LinearModel:
    """Median fill and scaling for numbers, one-hot for strings, balanced class weights.

    An unseen category gets an all-zero vector.
    """
    numeric, categories = list(numeric), list(categories)
    medians = column_medians(train, numeric)
    stats = class_balance(train, label).first()
    n0, n1 = stats["n_negative"], stats["n_positive"]
    if not n0 or not n1:
        raise ValueError("training rows need both classes")
    total = n0 + n1
    weight = F.when(F.col(label) == 1, total / (2 * n1)).otherwise(total / (2 * n0))
    rows = _filled(train, medians, categories).withColumn("_w", weight)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    stages = [
        StringIndexer(
            inputCols=categories, outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep"
        ),
        OneHotEncoder(
            inputCols=[f"{c}_ix" for c in categories],
            outputCols=[f"{c}_oh" for c in categories],
            dropLast=True,
        ),
        VectorAssembler(inputCols=numeric, outputCol="num"),
        StandardScaler(inputCol="num", outputCol="num_scaled", withMean=True),
        VectorAssembler(
            inputCols=["num_scaled", *[f"{c}_oh" for c in categories]], outputCol="features"
        ),
        LogisticRegression(labelCol=label, weightCol="_w", maxIter=max_iter),
    ]
    try:
        model = Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()
    return LinearModel(medians, categories, model)


def cross_validate(
    folded: DataFrame, folds: int, fit: Callable[[DataFrame], LinearModel], label: str = S.LABEL
) -> DataFrame:
    """Average precision per expanding-window fold: train on earlier blocks, test on the next."""
    out = None
    for i in range(1, folds + 1):
        train = folded.filter(F.col("block") < i)
        test = folded.filter(F.col("block") == i)
        scored = fit(train).score(test).select(
            F.lit(i).alias("fold"), F.col(label).alias("y"), F.col("probability").alias("score")
        )
        out = scored if out is None else out.unionByName(scored)
    return M.average_precision(M.score_curve(out, keys=["fold"]), ["fold"])


def cv_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.avg("auc_pr").alias("cv_mean"), F.stddev_pop("auc_pr").alias("cv_std"))


# --- boosted trees --------------------------------------------------------------------------

# How the usual boosting parameters map onto the Spark estimator.
PARAMETER_NAMES = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "feature_fraction": "featureSubsetStrategy",
    "bagging_fraction": "subsamplingRate",
    "min_child_weight": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode",
}
# Parameters without a counterpart (class weight goes into the weight column).
UNMAPPED = {"num_leaves", "reg_alpha", "reg_lambda", "scale_pos_weight"}


def map_parameters(params: dict) -> dict:
    """Usual boosting names to Spark names; parameters without a counterpart drop out."""
    out = {}
    for name, value in params.items():
        if name in UNMAPPED:
            continue
        target = PARAMETER_NAMES.get(name, name)
        out[target] = str(value) if target == "featureSubsetStrategy" else value
    return out


@dataclass
class BoostedModel:
    features: list[str]
    model: GBTClassificationModel
    best_iteration: int
    history: list[tuple[int, float]] = field(default_factory=list)

    def save(self, path: str) -> None:
        spark = running_session()
        self.model.write().overwrite().save(f"{path}/trees")
        facts = [(self.features, self.best_iteration)]
        spark.createDataFrame(facts, "features array<string>, best_iteration int").write.mode(
            "overwrite"
        ).json(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        facts = spark.read.json(f"{path}/facts").first()
        model = GBTClassificationModel.load(f"{path}/trees")
        return cls(list(facts["features"]), model, int(facts["best_iteration"]))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``margin`` and ``probability``. A NULL feature goes down as not a number."""
        wide = VectorAssembler(
            inputCols=self.features, outputCol="_features", handleInvalid="keep"
        ).transform(df)
        out = self.model.setFeaturesCol("_features").transform(wide)
        raw = vector_to_array("rawPrediction")[1]
        p = vector_to_array("probability")[1]
        return (
            out.withColumns({"margin": raw, "p1": p})
            .drop("_features", "rawPrediction", "probability", "prediction")
            .withColumnRenamed("p1", "probability")
        )


#: Margins (validation rows times trees) that are written and ranked at once.
JUDGED_CELLS = 1 << 26


def prefix_auc(
    model: GBTClassificationModel, features: Sequence[str], valid: DataFrame, label: str
) -> list[tuple[int, float]]:
    """Exact validation AUC of the first m trees, for every m."""
    return forest_auc(forest_of(model), features, valid, label)


def forest_auc(
    forest: Forest, features: Sequence[str], valid: DataFrame, label: str, known: int = 0
) -> list[tuple[int, float]]:
    """Exact validation AUC of the first m trees, for every m above ``known``.

    One pass adds up the trees of each row and counts equal margins; what it has counted is written,
    and its prefixes are ranked in one keyed curve. Where rows times trees are many, that is done for one
    block of trees after another: rows keep the margin before a block, and its counts are deleted after it.
    """
    spark = valid.sparkSession
    rows = valid.select(F.col(label).cast("bigint").alias("y"), *features).filter(F.col("y").isNotNull())
    block = max(1, JUDGED_CELLS // max(rows.count(), 1))
    out, walked, margins = [], 0, None
    for first in range(known, len(forest.roots), block):
        if first:
            rows, folder = _written(margin_after(rows, features, forest, walked, first), "margins")
            if margins:
                remove(spark, margins)
            walked, margins = first, folder
        counted, counts = _written(prefix_counts(rows, "y", features, forest, first, first + block), "prefixes")
        curve = M.counted_curve(counted, keys=["prefix"])
        judged = M.roc_auc(curve, ["prefix"]).orderBy("prefix").collect()
        # Sums come in any order: what differs in the last digits only is equal.
        out += [(r["prefix"], round(r["auc_roc"], 12)) for r in judged]
        remove(spark, counts)
        if first + block < len(forest.roots):
            del counted, curve
            spark._jvm.System.gc()  # shuffle files go with the plan that made them
    if margins:
        remove(spark, margins)
    return out


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table as ``stored`` reads it, and its folder, for what is deleted before the job ends."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def stop_at(history: Sequence[tuple[int, float]], patience: int) -> tuple[int, bool]:
    """(best iteration, whether ``patience`` iterations after it brought nothing better).

    Iterations after the stop do not count, whatever they would bring.
    """
    best, best_auc = 0, -math.inf
    for m, auc in history:
        if auc > best_auc:
            best, best_auc = m, auc
        elif m - best >= patience:
            return best, True
    return best, False


# Fixed value: rounds without a better validation AUC before training stops.
PATIENCE = 50
FIRST_ROUNDS = 64


def fit_boosted(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    params: dict,
    label: str = S.LABEL,
    weight: float | None = None,
    seed: int = 42,
    patience: int = PATIENCE,
    first_rounds: int = FIRST_ROUNDS,
) -> BoostedModel:
    """Cost-sensitive boosting that stops on validation AUC.

    Trees are trained in rounds that double from ``first_rounds`` until ``patience`` trees
    after the best prefix brought nothing better, or all are there; a longer run begins
    with the same trees as a shorter one. Every prefix is judged, once; the best is kept.
    """
    weight = positive_weight(train, label) if weight is None else weight
    features = list(features)
    mapped = map_parameters(params)
    all_rounds = int(mapped.pop("maxIter", 100))
    rows = (
        VectorAssembler(inputCols=features, outputCol="_features")
        .transform(train)
        .select(F.col(label).cast("double").alias("_y"), "_features",
                weight_column(label, weight).alias("_w"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    rounds = min(all_rounds, max(first_rounds, patience))
    forest, history = None, []
    try:
        while True:
            est = GBTClassifier(
                labelCol="_y", featuresCol="_features", weightCol="_w", seed=seed, maxIter=rounds, **mapped
            )
            model = est.fit(rows)
            shorter, forest = forest, forest_of(model)
            # Sums in another order can change a tree; what was judged counts up to there.
            known = forest.begins_like(shorter) if shorter else 0
            history = history[:known] + forest_auc(forest, features, valid, label, known)
            best, stopped = stop_at(history, patience)
            if stopped or rounds == all_rounds:
                break
            rounds = min(all_rounds, 2 * rounds)
    finally:
        rows.unpersist()
    if best < len(history):
        model = first_trees(model, best)
    return BoostedModel(features, model, best, history)


def ablation(
    data: DataFrame,
    feature_sets: dict[str, Sequence[str]],
    params: dict,
    label: str = S.LABEL,
    split: str = "split",
) -> DataFrame:
    """Train one model per feature set; rows of the run table with test metrics."""
    train, val, test = (data.filter(F.col(split) == s) for s in ("train", "val", "test"))
    weight = positive_weight(train, label)
    n_train = train.count()
    out = None
    for order, (name, features) in enumerate(feature_sets.items(), start=1):
        model = fit_boosted(train, val, features, params, label, weight)
        scored = model.score(test).select(
            F.col(label).alias("y"), F.col("probability").alias("score")
        )
        run = M.risk_metrics(scored, "class_weight", n_train).select(
            F.lit(name).alias("run_name"),
            F.lit(order).alias("run_order"),
            F.lit(len(features)).alias("n_features"),
            F.lit(model.best_iteration).alias("best_iteration"),
            "*",
        )
        out = run if out is None else out.unionByName(run)
    return out


# --- calibration ------------------------------------------------------------------------------


@dataclass
class Platt:
    slope: float
    intercept: float

    def apply(self, s: Column) -> Column:
        return sigmoid(F.lit(self.slope) * s + F.lit(self.intercept))


def fit_platt(valid: DataFrame, score: str, label: str = S.LABEL) -> Platt:
    """Sigmoid fit on validation scores with smoothed targets.

    Every row enters twice, as positive with weight t and as negative with 1 - t.
    """
    stats = class_balance(valid, label).first()
    hi = (stats["n_positive"] + 1) / (stats["n_positive"] + 2)
    lo = 1 / (stats["n_negative"] + 2)
    t = F.when(F.col(label) == 1, hi).otherwise(lo)
    sides = F.array(
        F.struct(F.lit(1.0).alias("_y"), t.alias("_w")),
        F.struct(F.lit(0.0).alias("_y"), (F.lit(1.0) - t).alias("_w")),
    )
    rows = valid.select(F.col(score).alias("_s"), F.inline(sides))
    wide = VectorAssembler(inputCols=["_s"], outputCol="features").transform(rows)
    model = LogisticRegression(
        labelCol="_y", weightCol="_w", regParam=0.0, maxIter=100, tol=1e-9
    ).fit(wide)
    return Platt(float(model.coefficients[0]), float(model.intercept))


# --- search -------------------------------------------------------------------------------------

# The search ranges (name, kind, low, high).
SEARCH_SPACE = [
    ("max_depth", "int", 4, 10),
    ("learning_rate", "log", 0.01, 0.15),
    ("min_child_weight", "int", 1, 20),
    ("subsample", "float", 0.6, 1.0),
    ("colsample_bytree", "float", 0.5, 1.0),
    ("scale_pos_weight", "float", 15.0, 40.0),
    ("n_estimators", "int", 500, 2000),
]
# Trials and how many run at once.
MAX_TRIALS, PARALLEL_TRIALS = 30, 3


def draw_trials(
    spark: SparkSession, n: int, seed: int, space: Sequence[tuple] = tuple(SEARCH_SPACE)
) -> list[dict]:
    """Repeatable draws, uniform or log-uniform, from the ranges."""
    from riskweave.functions.columns import hash_unit

    cols = [
        hash_unit(F.concat_ws("/", F.col("id").cast("string"), F.lit(name)), seed).alias(name)
        for name, *_ in space
    ]
    rows = spark.range(1, n + 1).select("id", *cols).orderBy("id").collect()
    return [params_of([row[name] for name, *_ in space], space) for row in rows]


def search(
    spark: SparkSession,
    trials: Sequence[dict],
    objective: Callable[[dict], float],
    parallel: int = PARALLEL_TRIALS,
    first: int = 1,
) -> DataFrame:
    """Run the trials, numbered from ``first``, as concurrent jobs; a failed one becomes an infeasible row."""

    def one(item: tuple[int, dict]) -> tuple:
        number, params = item
        shown = {k: float(v) for k, v in params.items()}
        try:
            return (number, shown, "completed", None, float(objective(params)))
        except Exception as e:  # the search goes on
            return (number, shown, "infeasible", str(e).strip() or type(e).__name__, None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(one, enumerate(trials, start=first)))
    return spark.createDataFrame(rows, TRIALS)


def unit_point(params: dict, space: Sequence[tuple]) -> list[float]:
    """Parameters as a point of the unit cube."""
    out = []
    for name, kind, low, high in space:
        v, low, high = (math.log(x) if kind == "log" else float(x) for x in (params[name], low, high))
        out.append((v - low) / (high - low) if high > low else 0.0)
    return out


def params_of(point: Sequence[float], space: Sequence[tuple]) -> dict:
    """The parameters at a point of the unit cube."""
    out = {}
    for u, (name, kind, low, high) in zip(point, space, strict=True):
        if kind == "log":
            out[name] = math.exp(math.log(low) + float(u) * (math.log(high) - math.log(low)))
        elif kind == "int":
            out[name] = min(high, low + int(u * (high - low + 1)))
        else:
            out[name] = low + float(u) * (high - low)
    return out


class Surrogate:
    """A Gaussian process over judged points; scores are standardised, the length scale is the likeliest."""

    def __init__(self, x: np.ndarray, y: np.ndarray, noise: float = 1e-4):
        self.x, self.mean, self.spread = x, y.mean(), y.std() or 1.0
        z = (y - self.mean) / self.spread
        best = -math.inf
        for length in (0.1, 0.2, 0.4, 0.8, 1.6):
            root = np.linalg.cholesky(self.kernel(x, x, length) + noise * np.eye(len(x)))
            weights = np.linalg.solve(root.T, np.linalg.solve(root, z))
            likelihood = -0.5 * z @ weights - np.log(np.diag(root)).sum()
            if likelihood > best:
                best, self.length, self.root, self.weights = likelihood, length, root, weights

    @staticmethod
    def kernel(a: np.ndarray, b: np.ndarray, length: float) -> np.ndarray:
        """Matern, of smoothness 5/2."""
        d = np.sqrt(5 * ((a[:, None] - b[None]) ** 2).sum(axis=2)) / length
        return (1 + d + d**2 / 3) * np.exp(-d)

    def improvement(self, points: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
        """(expected improvement over ``top``, expected score) of each point."""
        k = self.kernel(points, self.x, self.length)
        mean = k @ self.weights
        half = np.linalg.solve(self.root, k.T)
        spread = np.sqrt(np.maximum(1 - (half**2).sum(axis=0), 1e-12))
        gain = mean - (top - self.mean) / self.spread
        u = gain / spread
        below = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in u])
        density = np.exp(-(u**2) / 2) / math.sqrt(2 * math.pi)
        return self.spread * (gain * below + spread * density), self.spread * mean + self.mean


#: Points among which the next trials are chosen.
CANDIDATES = 2_000


def propose(
    judged: Sequence[tuple[dict, float | None]], n: int, seed: int, space: Sequence[tuple]
) -> list[dict]:
    """The next ``n`` trials: points of the largest expected improvement, one after another.

    ``judged``: (parameters, score), without a score for an infeasible trial, which counts as the worst
    there is. A point once chosen counts as judged at its expected score, so the next lies elsewhere.
    """
    scores = [s for _, s in judged if s is not None]
    x = np.array([unit_point(p, space) for p, _ in judged])
    # How bad the bad ones are says little of where the best are.
    middle = float(np.median(scores))
    worst = middle - (max(scores) - middle)
    y = np.array([worst if s is None else max(s, worst) for _, s in judged], float)
    rng = np.random.default_rng([seed, len(judged)])
    top = x[np.argmax(y)]
    near = np.clip(top + 0.1 * rng.normal(size=(CANDIDATES // 4, len(space))), 0, 1)
    points = np.concatenate([rng.random((CANDIDATES, len(space))), near])
    out = []
    for _ in range(n):
        gain, expected = Surrogate(x, y).improvement(points, max(scores))
        best = int(np.argmax(gain))
        out.append(params_of(points[best], space))
        x, y = np.vstack([x, unit_point(out[-1], space)]), np.append(y, expected[best])
    return out


TRIALS = "trial int, params map<string,double>, state string, reason string, auc_pr double"


def run_search(
    spark: SparkSession,
    objective: Callable[[dict], float],
    n: int = MAX_TRIALS,
    seed: int = 42,
    space: Sequence[tuple] = tuple(SEARCH_SPACE),
    parallel: int = PARALLEL_TRIALS,
    starts: int = 2 * PARALLEL_TRIALS,
    path: str | None = None,
) -> DataFrame:
    """The whole search: ``starts`` draws from the ranges, then batches of ``parallel`` trials that a
    surrogate of the trials so far proposes, ``n`` in all.

    With ``path``, each batch is added to the table of trials there, and a search that finds one
    goes on with it.
    """
    whole = {name for name, kind, *_ in space if kind == "int"}
    rows: list = []
    if path is not None and exists(spark, path):
        rows = sorted(spark.read.schema(TRIALS).json(path).collect(), key=lambda r: r["trial"])
    drawn = draw_trials(spark, min(starts, n), seed, space)
    while len(rows) < n:
        more = min(parallel, n - len(rows))
        judged = [({k: int(v) if k in whole else v for k, v in r["params"].items()}, r["auc_pr"]) for r in rows]
        if len(rows) < len(drawn):
            trials = drawn[len(rows) : len(rows) + more]
        elif any(s is not None for _, s in judged):
            trials = propose(judged, more, seed, space)
        else:  # nothing has worked yet
            trials = draw_trials(spark, len(rows) + more, seed, space)[len(rows) :]
        found = search(spark, trials, objective, parallel, len(rows) + 1).collect()  # a few rows
        if path is not None:
            spark.createDataFrame(found, TRIALS).coalesce(1).write.mode("append").json(path)
        rows += sorted(found, key=lambda r: r["trial"])
    return spark.createDataFrame(rows, TRIALS)


def save_best(trials: DataFrame, path: str) -> dict:
    """Write the parameters of the best trial as one JSON line; returns them."""
    best = best_params(trials)
    spark = trials.sparkSession
    spark.createDataFrame([(best,)], "params map<string,double>").coalesce(1).write.mode("overwrite").json(path)
    return best


def load_best(spark: SparkSession, path: str) -> dict:
    row = spark.read.schema("params map<string,double>").json(path).first()
    whole = {name for name, kind, *_ in SEARCH_SPACE if kind == "int"}
    return {k: int(v) if k in whole else v for k, v in row["params"].items()}


def choose(candidates: dict[str, DataFrame]) -> tuple[str, DataFrame]:
    """The candidate with the best average precision of its scored validation rows (y, score),
    the first of equals, and the table (run_name, run_order, auc_pr) it was chosen from."""
    out = None
    for order, (name, scored) in enumerate(candidates.items(), start=1):
        ap = M.average_precision(M.score_curve(scored)).select(
            F.lit(name).alias("run_name"), F.lit(order).alias("run_order"), "auc_pr"
        )
        out = ap if out is None else out.unionByName(ap)
    table = out.sparkSession.createDataFrame(out.collect(), out.schema)  # one row a candidate
    return R.require_champion(table)["run_name"], table


def best_params(trials: DataFrame) -> dict:
    row = (
        trials.filter(F.col("state") == "completed")
        .agg(F.max_by("params", F.struct(F.col("auc_pr"), -F.col("trial"))).alias("p"))
        .first()
    )
    if row["p"] is None:
        raise ValueError("no trial completed")
    return dict(row["p"])
