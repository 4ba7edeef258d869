"""Boosted trees on binned columns: the usual parameters, a direction for missing values, runs that go on.

Columns are cut into bins once and rows stored as one byte a column. A level of a tree is one job: tasks
add up gradients per node, column and bin, Spark sums the cells and picks each node's best split, and
only that split comes to the driver. Gradients are whole multiples of 2**-24, so sums, and with them
the trees, do not depend on how rows are dealt or which task ran twice.

Trees are grown to ``max_depth`` and then cut back to ``num_leaves``, most gain first; this is what growing
leaf by leaf gives, since a node's best split does not depend on other nodes. A run that goes on adds trees to those
it has: margins of the stored trees are walked once, no tree is fitted again. It ends up with the same
trees as a run that was never stopped.

Defined cases: NULL and not-a-number are missing, which go where the training gain is higher, to the
right on a tie and where training had none; rows without a label take no part; of equal gains the first
column, then the lowest threshold wins; no rows, or one class only, give trees without splits or a
base margin from half a row of the other class; without an AUC on the validation rows all trees stay.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.operators import metrics as M
from riskweave.operators.models import PATIENCE, stop_at
from riskweave.operators.trees import Forest
from riskweave.session import remove, running_session, stored
from riskweave.sources import schema as S

# A byte holds a bin; the last number stands for a missing value.
BINS, MISSING = 254, 255
SCALE = float(1 << 24)
# Cells (node, column, bin) that a task holds at once; wider levels take several passes.
CELLS = 1 << 21
# Trees between two looks at the validation rows, after which margins are stored.
BLOCK = 16

# Other usual names of the same parameters.
SAME = {"bagging_fraction": "subsample", "feature_fraction": "colsample_bytree"}


@dataclass
class Settings:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    num_leaves: int = 0  # 0: as many as the depth allows
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1e-3
    min_child_samples: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    scale_pos_weight: float = 1.0
    seed: int = 42

    @classmethod
    def of(cls, params: dict) -> Settings:
        return cls(**{SAME.get(k, k): v for k, v in params.items()})


# --- bins ---------------------------------------------------------------------------------------


def find_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper bounds of each column's bins; the last is infinity.

    A column with at most ``bins`` values has one bin a value, exactly. Others are cut at quantiles of a
    mergeable sketch. The driver gets at most ``bins`` numbers a column.
    """
    names = list(features)

    def few(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: list[set | None] = [set() for _ in names]
        for pdf in batches:
            for j, name in enumerate(names):
                if seen[j] is not None:
                    values = pdf[name].to_numpy(dtype=float)
                    seen[j].update(np.unique(values[~np.isnan(values)]).tolist())
                    if len(seen[j]) > bins:
                        seen[j] = None
        rows = [(j, v) for j, s in enumerate(seen) for v in ([math.nan] if s is None else s)]
        yield pd.DataFrame(rows, columns=["feature", "value"]).astype({"feature": "int32", "value": "float64"})

    doubles = df.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    values = stored(doubles.mapInPandas(few, "feature int, value double").distinct(), "values")
    over = F.count_if(F.col("value").isNull() | F.isnan("value")).alias("over")
    sizes = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), over).collect()
    many = sorted(r["feature"] for r in sizes if r["n"] > bins or r["over"])
    out: list[list[float]] = [[] for _ in names]
    for r in values.filter(~F.col("feature").isin([*many, -1])).orderBy("feature", "value").collect():
        out[r["feature"]].append(r["value"])
    if many:
        shares = [(i + 1) / bins for i in range(bins)]
        cuts = doubles.select([F.percentile_approx(F.nanvl(names[j], F.lit(None)), shares, 10_000).alias(f"q{j}") for j in many])
        row = cuts.first()
        for j in many:
            out[j] = sorted(set(row[f"q{j}"]))
    return [[*edges[:-1], math.inf] if edges else [math.inf] for edges in out]


def _bin_rows(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(e, x[:, j]))
    return out


def _values(bins: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, the same as numbers with missing ones as not a number)."""
    b = np.frombuffer(b"".join(bins), np.uint8).reshape(len(bins), width)
    x = b.astype(np.float32)
    x[b == MISSING] = np.nan
    return b, x


# --- the model ----------------------------------------------------------------------------------


@dataclass
class Ensemble:
    """Trees as lists of nodes [feature, bin, missing goes left, left, right, value, rows]; leaves have feature -1.

    ``best`` trees are used; those fitted beyond it are kept for a run that goes on.
    """

    features: list[str]
    edges: list[list[float]]
    base: float
    settings: Settings
    trees: list[list[list]] = field(default_factory=list)
    history: list[tuple[int, float]] = field(default_factory=list)
    best: int = 0

    def forest(self, n: int | None = None) -> Forest:
        """The first ``n`` trees (the best prefix) over values of the columns."""
        forest = nodes_as_arrays(self.trees[: self.best if n is None else n])
        inner = forest.feature >= 0
        forest.threshold[inner] = [self.edges[f][int(b)] for f, b in zip(forest.feature[inner], forest.threshold[inner])]
        return forest

    def margin(self, names: Sequence[str] | None = None) -> Column:
        shared = running_session().sparkContext.broadcast((self.base, self.forest()))

        @F.pandas_udf("double")
        def walk(rows: pd.Series) -> pd.Series:
            base, forest = shared.value
            x = np.stack(rows.to_numpy()) if len(rows) else np.empty((0, 1))
            return pd.Series(moved(np.full(len(rows), base), forest, x))

        wide = [F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(math.nan)) for n in names or self.features]
        return walk(F.array(*wide))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``margin`` and ``probability``."""
        out = df.withColumn("margin", self.margin())
        return out.withColumn("probability", 1 / (1 + F.exp(-F.col("margin"))))

    def save(self, path: str) -> None:
        spark = running_session()
        text = json.dumps({**asdict(self), "edges": [e[:-1] for e in self.edges]})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        facts = json.loads(spark.read.text(path).first()[0])
        facts["edges"] = [[*e, math.inf] for e in facts["edges"]]
        facts["settings"] = Settings(**facts["settings"])
        facts["history"] = [tuple(h) for h in facts["history"]]
        return cls(**facts)


def nodes_as_arrays(trees: Sequence[Sequence[Sequence]]) -> Forest:
    """All trees one after another, thresholds as bins."""
    roots = np.cumsum([0, *[len(t) for t in trees]])[:-1].astype(np.int64)
    rows = [(f, b, m, left + start, right + start, v, n) for start, t in zip(roots.tolist(), trees) for f, b, m, left, right, v, n in t]
    c = np.array(rows, dtype=float).reshape(-1, 7)
    return Forest(c[:, 0].astype(np.int64), c[:, 1].copy(), c[:, 3].astype(np.int64), c[:, 4].astype(np.int64), c[:, 5], c[:, 6],
                  roots, c[:, 2].astype(bool))


def moved(margin: np.ndarray, forest: Forest, x: np.ndarray) -> np.ndarray:
    """Margins after the trees, added one after another: the same sum wherever a run was stopped."""
    for root in forest.roots.tolist():
        margin = margin + forest.value[forest.reach(root, x)]
    return margin


# --- rows ---------------------------------------------------------------------------------------


def _binned(df: DataFrame, model: Ensemble, label: str, key: str) -> DataFrame:
    """(bins, y, draw, margin): the table that all passes read, with the margin of the trees there are."""
    names, edges = model.features, [np.array(e) for e in model.edges]
    shared = df.sparkSession.sparkContext.broadcast(nodes_as_arrays(model.trees))
    base = model.base

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            b = _bin_rows(pdf[[f"_{j}" for j in range(len(names))]].to_numpy(dtype=float), edges)
            x = b.astype(np.float32)
            x[b == MISSING] = np.nan
            margin = moved(np.full(len(pdf), base), shared.value, x)
            yield pd.DataFrame({"bins": [r.tobytes() for r in b], "y": pdf["_y"], "draw": pdf["_draw"], "margin": margin})

    wide = df.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("_y"), F.xxhash64(key).alias("_draw"),
        *[F.col(f"`{n}`").cast("double").alias(f"_{j}") for j, n in enumerate(names)],
    )
    return stored(wide.mapInPandas(run, "bins binary, y double, draw long, margin double"), "binned")


def _go_on(rows: DataFrame, trees: list, width: int) -> DataFrame:
    """The rows with the margins after further trees, in place of the table they were in."""
    shared = rows.sparkSession.sparkContext.broadcast(nodes_as_arrays(trees))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["margin"] = moved(pdf["margin"].to_numpy(), shared.value, _values(pdf["bins"], width)[1])
            yield pdf

    out = stored(rows.mapInPandas(run, rows.schema), "binned")
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        remove(rows.sparkSession, folder)
    return out


def drawn(draw: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree is fitted on: a digest of the row's own and the tree's number."""
    if share >= 1:
        return np.ones(len(draw), bool)
    z = draw.astype(np.int64).view(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * (1 << 64)))


def is_drawn(key: str, tree: int, s: Settings) -> Column:
    """Whether a row is among those that a tree is fitted on."""
    return F.pandas_udf(lambda d: pd.Series(drawn(d.to_numpy(), tree, s.seed, s.subsample)), "boolean")(F.xxhash64(key))


def columns_of(tree: int, width: int, s: Settings) -> list[int]:
    """The columns that a tree may split on."""
    n = max(1, math.ceil(s.colsample_bytree * width)) if width else 0
    return sorted(np.random.default_rng([s.seed, tree]).permutation(width)[:n].tolist())


# --- one tree -----------------------------------------------------------------------------------


def _cells(rows: DataFrame, block: list, grown: list, at: list[int], tree: int, columns: list[int], width: int, s: Settings) -> DataFrame:
    """(slot, feature, bin, g, h, n): gradient sums of the nodes ``at`` of the tree in growth."""
    slots = np.full(len(grown), -1)
    slots[at] = np.arange(len(at))
    shared = rows.sparkSession.sparkContext.broadcast((nodes_as_arrays(block), nodes_as_arrays([grown]), slots))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, growing, slots = shared.value
        total = np.zeros((3, len(columns), len(at) * 256))
        for pdf in batches:
            b, x = _values(pdf["bins"], width)
            y = pdf["y"].to_numpy()
            p = 1 / (1 + np.exp(-moved(pdf["margin"].to_numpy(), before, x)))
            w = np.where(y == 1, s.scale_pos_weight, 1.0)
            slot = slots[growing.reach(0, x)]
            keep = (slot >= 0) & drawn(pdf["draw"].to_numpy(), tree, s.seed, s.subsample)
            sums = [np.rint(w * (p - y) * SCALE)[keep], np.rint(w * p * (1 - p) * SCALE)[keep], None]
            for j, f in enumerate(columns):
                cell = slot[keep] * 256 + b[keep, f]
                for k, weights in enumerate(sums):
                    total[k, j] += np.bincount(cell, weights, minlength=len(at) * 256)
        j, cell = np.nonzero(total[2])
        g, h, n = total[:, j, cell].astype(np.int64)
        yield pd.DataFrame({"slot": (cell // 256).astype(np.int32), "feature": np.array(columns, np.int32)[j],
                            "bin": (cell % 256).astype(np.int32), "g": g, "h": h, "n": n})

    parts = rows.mapInPandas(run, "slot int, feature int, bin int, g long, h long, n long")
    # Tasks have summed their cells: one shuffle serves the sums, the running sums and the choice.
    return parts.repartition("slot", "feature").groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])


def _strength(g: Column, h: Column, s: Settings) -> Column:
    size = F.greatest(F.abs(g) / SCALE - s.reg_alpha, F.lit(0.0))
    below = h / SCALE + s.reg_lambda
    return F.when(below > 0, size * size / below).otherwise(0.0)


def best_splits(cells: DataFrame, s: Settings) -> DataFrame:
    """One row a slot: its best split (gain -1: none) and the sums on the left and in all."""
    group = Window.partitionBy("slot", "feature")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    missing = F.col("bin") == MISSING
    sums = {}
    for c in "ghn":
        sums[f"all_{c}"] = F.sum(c).over(group)
        sums[f"upto_{c}"] = F.sum(c).over(upto)
        sums[f"miss_{c}"] = F.coalesce(F.sum(F.when(missing, F.col(c))).over(group), F.lit(0))
    way = [
        F.struct(F.lit(m).alias("missing_left"),
                 *[(F.col(f"upto_{c}") + (F.col(f"miss_{c}") if m else F.lit(0))).alias(f"left_{c}") for c in "ghn"])
        for m in (0, 1)
    ]
    rows = cells.withColumns(sums).select("*", F.inline(F.array(*way)))
    right = {c: F.col(f"all_{c}") - F.col(f"left_{c}") for c in "ghn"}
    gain = 0.5 * (_strength(F.col("left_g"), F.col("left_h"), s) + _strength(right["g"], right["h"], s)
                  - _strength(F.col("all_g"), F.col("all_h"), s))
    allowed = ~missing & (F.least("left_n", right["n"]) >= max(1, s.min_child_samples))
    allowed &= F.least("left_h", right["h"]) / SCALE >= s.min_child_weight
    allowed &= (F.col("missing_left") == 0) | (F.col("miss_n") > 0)
    # Gains that differ in the last digits only are equal.
    gain = F.round(F.when(allowed & (gain > 0), gain).otherwise(-1.0), 9)
    pick = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"),
                    (-F.col("missing_left")).alias("m"), *[f"left_{c}" for c in "ghn"], *[f"all_{c}" for c in "ghn"])
    each = rows.groupBy("slot", "feature").agg(F.max(pick).alias("pick"))
    return each.groupBy("slot").agg(F.max("pick").alias("best")).select("slot", "best.*")


def leaf_value(g: int, h: int, s: Settings) -> float:
    size = max(abs(g) / SCALE - s.reg_alpha, 0.0)
    below = h / SCALE + s.reg_lambda
    return -math.copysign(size / below, g) * s.learning_rate if below > 0 and size > 0 else 0.0


def grow_tree(rows: DataFrame, block: list, tree: int, width: int, s: Settings) -> list[list]:
    """The next tree; ``block`` has the trees since margins were stored."""
    grown = [[-1, 0, 0, 0, 0, 0.0, 0]]
    gains: dict[int, float] = {}
    columns = columns_of(tree, width, s)
    level = [0]
    step = max(1, CELLS // (256 * max(1, len(columns))))
    for _ in range(max(1, s.max_depth)):
        found = []
        for i in range(0, len(level), step):
            at = level[i : i + step]
            cells = _cells(rows, block, grown, at, tree, columns, width, s)
            found += [(at[r["slot"]], r) for r in best_splits(cells, s).collect()]
        level = []
        for node, r in sorted(found, key=lambda pair: pair[0]):
            if node == 0:
                grown[0][5:] = [leaf_value(r["all_g"], r["all_h"], s), r["all_n"]]
            if r["gain"] <= 0 or s.max_depth < 1:
                continue
            left = len(grown)
            gains[node] = r["gain"]
            grown[node][:5] = [-r["f"], -r["b"], -r["m"], left, left + 1]
            rest = [r[f"all_{c}"] - r[f"left_{c}"] for c in "ghn"]
            for g, h, n in ((r["left_g"], r["left_h"], r["left_n"]), rest):
                grown.append([-1, 0, 0, 0, 0, leaf_value(g, h, s), n])
            level += [left, left + 1]
        if not level:
            break
    return keep_leaves(grown, gains, s.num_leaves)


def keep_leaves(grown: list[list], gains: dict[int, float], leaves: int) -> list[list]:
    """The tree of at most ``leaves`` leaves that splits the most gain first; of equal ones the node made first."""
    open_, split = [0], set()
    while leaves < 1 or len(split) + 1 < leaves:
        ready = [n for n in open_ if n in gains]
        if not ready:
            break
        node = max(ready, key=lambda n: (gains[n], -n))
        open_.remove(node)
        open_ += grown[node][3:5]
        split.add(node)
    order, new = [0], []
    for node in order:  # grows while it is walked
        f, b, m, left, right, value, n = grown[node]
        if node in split:
            new.append([f, b, m, len(order), len(order) + 1, value, n])
            order += [left, right]
        else:
            new.append([-1, 0, 0, 0, 0, value, n])
    return new


# --- the run ------------------------------------------------------------------------------------


def _judge(rows: DataFrame, trees: list, first: int, width: int) -> list[tuple[int, float]]:
    """Exact AUC after each of the trees, which follow ``first`` others."""
    shared = rows.sparkSession.sparkContext.broadcast(nodes_as_arrays(trees))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            forest, x = shared.value, _values(pdf["bins"], width)[1]
            margin, out = pdf["margin"].to_numpy(), []
            for root in forest.roots.tolist():
                margin = margin + forest.value[forest.reach(root, x)]
                out.append(margin)
            yield pd.DataFrame({"y": pdf["y"], "margins": list(np.stack(out, axis=1))})

    margins = rows.mapInPandas(run, "y double, margins array<double>")
    long = margins.select("y", F.posexplode("margins").alias("prefix", "score"))
    found = M.roc_auc(M.score_curve(long, keys=["prefix"]), ["prefix"]).orderBy("prefix").collect()
    return [(first + r["prefix"] + 1, round(r["auc_roc"], 12)) for r in found if r["auc_roc"] is not None]


def base_margin(df: DataFrame, label: str, s: Settings) -> float:
    pos, neg = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    if not pos and not neg:
        return 0.0
    return math.log(s.scale_pos_weight * (pos or 0.5) / (neg or 0.5))


def boost(
    train: DataFrame, valid: DataFrame, features: Sequence[str], params: dict, label: str = S.LABEL, key: str = S.KEY,
    patience: int = PATIENCE, block: int = BLOCK, start: Ensemble | None = None,
) -> Ensemble:
    """Fit up to ``n_estimators`` trees, those of ``start`` included, until ``patience`` trees brought nothing better.

    Validation rows are looked at every ``block`` trees, so at most ``block`` - 1 trees are fitted beyond
    the stop. ``start`` keeps its bins, base margin and all its trees; of ``params`` only the number of
    trees may differ from its own.
    """
    s = Settings.of(params)
    if start is None:
        known = train.filter(F.col(label).isNotNull())
        model = Ensemble(list(features), find_edges(known, features), base_margin(train, label, s), s)
    else:
        if replace(start.settings, n_estimators=s.n_estimators) != s or start.features != list(features):
            raise ValueError("a run goes on with the columns and parameters it began with")
        model = replace(start, settings=s, trees=[*start.trees], history=[*start.history])
    width = len(model.features)
    rows, judged = (_binned(df, model, label, key) for df in (train, valid))
    stopped = stop_at(model.history, patience)[1]
    while not stopped and len(model.trees) < s.n_estimators:
        first, new = len(model.trees), []
        for tree in range(first, min(s.n_estimators, first + block)):
            new.append(grow_tree(rows, new, tree, width, s))
        model.history += _judge(judged, new, first, width)
        model.trees += new
        stopped = stop_at(model.history, patience)[1]
        if not stopped and len(model.trees) < s.n_estimators:
            rows, judged = _go_on(rows, new, width), _go_on(judged, new, width)
    model.best = stop_at(model.history, patience)[0] or len(model.trees)
    return model
