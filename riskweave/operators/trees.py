"""Fitted tree ensembles as arrays, read from the node table of the saved model."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import new_folder, running_session


@dataclass
class Forest:
    """Nodes of all trees, tree after tree. A leaf has feature -1; rows go left if
    their value is at most the threshold. A missing value goes right, or where ``missing_left`` says."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # prediction times the tree's weight
    cover: np.ndarray  # weighted training rows that reached the node
    roots: np.ndarray
    missing_left: np.ndarray | None = None

    def goes_left(self, values: np.ndarray, node: np.ndarray | int) -> np.ndarray:
        left = values <= self.threshold[node]
        return left if self.missing_left is None else left | (np.isnan(values) & self.missing_left[node])

    def reach(self, root: int, x: np.ndarray) -> np.ndarray:
        """The leaf each row ends in."""
        rows, node = np.arange(len(x)), np.full(len(x), root)
        while True:
            f = self.feature[node]
            open_ = f >= 0
            if not open_.any():
                return node
            left = self.goes_left(x[rows[open_], f[open_]], node[open_])
            node[open_] = np.where(left, self.left[node[open_]], self.right[node[open_]])

    def margins(self, x: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Each tree's share of the margin: one column a tree, of all or from ``first`` to before ``last``."""
        roots = self.roots[first:last]
        out = np.empty((len(x), len(roots)))
        for t, root in enumerate(roots):
            out[:, t] = self.value[self.reach(root, x)]
        return out

    def begins_like(self, other: Forest) -> int:
        """The number of trees, from the first on, that are the same in both."""
        n = min(len(self.roots), len(other.roots))
        ends = [*self.roots[1:], len(self.feature)]
        for t in range(n):
            nodes = slice(self.roots[t], ends[t])
            parts = ("feature", "threshold", "left", "right", "value")
            if any(not np.array_equal(getattr(self, c)[nodes], getattr(other, c)[nodes]) for c in parts):
                return t
        return n

    def depth(self, root: int) -> int:
        """Edges on the longest path below a root."""
        deepest, open_ = 0, [(root, 0)]
        while open_:
            node, d = open_.pop()
            deepest = max(deepest, d)
            if self.feature[node] >= 0:
                open_ += [(int(self.left[node]), d + 1), (int(self.right[node]), d + 1)]
        return deepest


def forest_of(model: GBTClassificationModel) -> Forest:
    """The arrays of a fitted ensemble; its size is set by the training parameters."""
    spark = running_session()
    path = new_folder(spark, "trees")
    model.write().save(path)
    n = F.col("nodeData")
    rows = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID", n["id"].alias("id"), n["prediction"].alias("prediction"),
            n["impurityStats"][0].alias("cover"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
            n["split"]["featureIndex"].alias("feature"),
            F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        )
        .toArrow()
        .sort_by([("treeID", "ascending"), ("id", "ascending")])
        .to_pandas()
    )
    tree = rows["treeID"].to_numpy()
    roots = np.searchsorted(tree, np.arange(tree[-1] + 1))
    start = roots[tree]  # ids count from 0 in each tree
    leaf = rows["left"].to_numpy() < 0
    return Forest(
        np.where(leaf, -1, rows["feature"].fillna(-1).to_numpy()).astype(np.int64),
        rows["threshold"].fillna(0.0).to_numpy(),
        np.where(leaf, 0, start + rows["left"].to_numpy()),
        np.where(leaf, 0, start + rows["right"].to_numpy()),
        rows["prediction"].to_numpy() * np.array(model.treeWeights)[tree],
        rows["cover"].to_numpy(),
        roots,
    )


def prefix_margins(df: DataFrame, keep: Sequence[str], features: Sequence[str], forest: Forest) -> DataFrame:
    """(keep..., margins): after each tree the margin so far."""
    shared = df.sparkSession.sparkContext.broadcast(forest)
    keep, names = list(keep), list(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keep].copy()
            x = pdf[names].to_numpy(dtype=float)
            out["margins"] = list(np.cumsum(shared.value.margins(x), axis=1))
            yield out

    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", margins array<double>"
    return df.select(*keep, *[n for n in names if n not in keep]).mapInPandas(run, schema)


#: The column of margins that ``margin_after`` adds.
BEFORE = "_before"


def margin_after(df: DataFrame, features: Sequence[str], forest: Forest, first: int, last: int) -> DataFrame:
    """The rows with the margin of the trees before ``last``, from that of the trees before ``first`` on."""
    shared = df.sparkSession.sparkContext.broadcast(forest)
    names = list(features)
    out = df if BEFORE in df.columns else df.withColumn(BEFORE, F.lit(0.0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, margin = pdf[names].to_numpy(dtype=float), pdf[BEFORE].to_numpy(dtype=float)
            for root in shared.value.roots[first:last]:
                margin = margin + shared.value.value[shared.value.reach(root, x)]
            yield pdf.assign(**{BEFORE: margin})

    return out.mapInPandas(run, out.schema)


#: Margins (rows times trees) that a task counts at once.
CELLS = 1 << 22


def prefix_counts(
    df: DataFrame, label: str, features: Sequence[str], forest: Forest, first: int = 0, last: int | None = None
) -> DataFrame:
    """(prefix, score, pos, neg): for each number of trees the margins, and the rows of each class that have one.

    Only prefixes longer than ``first`` trees, up to ``last``; the rows then hold the margin before them
    (``margin_after``). Tasks count equal margins in blocks of rows, so a margin may come in several rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(forest)
    names = list(features)
    block = max(1, CELLS // max(len(forest.roots[first:last]), 1))

    def count(y: np.ndarray, before: np.ndarray, x: np.ndarray) -> Iterator[pd.DataFrame]:
        margins = shared.value.margins(x, first, last)
        margins[:, 0] += before
        margins = np.cumsum(margins, axis=1)
        for t in range(margins.shape[1]):
            scores, back = np.unique(margins[:, t], return_inverse=True)
            pos = np.bincount(back, y, len(scores)).astype(np.int64)
            neg = np.bincount(back, minlength=len(scores)) - pos
            yield pd.DataFrame({"prefix": first + t + 1, "score": scores, "pos": pos, "neg": neg})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for at in range(0, len(pdf), block):
                part = pdf.iloc[at : at + block]
                if size + len(part) > block:
                    yield from count(*(np.concatenate(c) for c in zip(*held)))
                    held, size = [], 0
                held.append(tuple(part[c].to_numpy(dtype=float) for c in (label, BEFORE, names)))
                size += len(part)
        if held:
            yield from count(*(np.concatenate(c) for c in zip(*held)))

    before = F.col(BEFORE) if first else F.lit(0.0).alias(BEFORE)
    rows = df.select(label, before, *[n for n in names if n != label])
    return rows.mapInPandas(run, "prefix int, score double, pos long, neg long")


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of the first ``n`` trees, through the saved form of the model."""
    spark = running_session()
    whole, part = new_folder(spark, "trees"), new_folder(spark, "trees")
    model.write().save(whole)
    spark.read.parquet(f"{whole}/data").filter(F.col("treeID") < n).write.parquet(f"{part}/data")
    spark.read.parquet(f"{whole}/treesMetadata").filter(F.col("_1") < n).write.parquet(f"{part}/treesMetadata")
    facts = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    facts["numTrees"] = n
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{part}/metadata")
    return GBTClassificationModel.load(part)
