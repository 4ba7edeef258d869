"""Score explanations: closed form for linear models, path-wise Shapley for trees."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import direction_text, r6
from riskweave.operators.quality import sorted_rank
from riskweave.operators.trees import Forest, forest_of


def marginal_slopes(df: DataFrame, features: Sequence[str], label: str) -> dict:
    """Per feature: (least-squares slope of the label, mean). One pass."""
    row = df.agg(
        *[
            e
            for f in features
            for e in (F.regr_slope(label, f).alias(f"{f}_b"), F.avg(f).alias(f"{f}_m"))
        ]
    ).first()
    return {f: (row[f"{f}_b"] or 0.0, row[f"{f}_m"] or 0.0) for f in features}


def linear_attribution(df: DataFrame, key: str, model: dict[str, tuple[float, float]]) -> DataFrame:
    """(key, feature, value): coefficient times distance from the mean."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"), ((F.col(f) - F.lit(m)) * F.lit(b)).alias("value")
        )
        for f, (b, m) in model.items()
    ]
    return df.select(key, F.inline(F.array(*entries)))


def importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))


def ranked_importance(attributions: DataFrame, top: int | None = None) -> DataFrame:
    """Importance with its rank; one row per feature, so the sort is small."""
    out = sorted_rank(importance(attributions), [F.col("importance").desc(), F.col("feature")])
    return out if top is None else out.filter(F.col("rank") <= top)


def top_attributions(df: DataFrame, key: str, model: dict, k: int = 3) -> DataFrame:
    """Per row the k largest attributions by size, inside the row: no shuffle."""
    parts = {f: ((F.col(f) - F.lit(m)) * F.lit(b)).alias(f"_part_{f}") for f, (b, m) in model.items()}
    return top_parts(df.select(key, *parts.values()), key, {f: f"_part_{f}" for f in parts}, k)


# --- trees -----------------------------------------------------------------------


#: Rows whose path products are held at once.
ROWS = 2_048


def path_shapley(x: np.ndarray, forest: Forest) -> np.ndarray:
    """Path-dependent Shapley values of all rows, one walk over the nodes of each tree.

    A feature outside a coalition lets a row through with the cover share z of its edges; inside, the
    row passes (o = 1) or not (0). The Shapley weights of coalitions of s of m - 1 features are the
    integrals of t**s (1 - t)**(m - 1 - s) over 0..1, so the value of a feature on one path is the
    integral of (o - z) times the product of z (1 - t) + o t over the path's other features: a
    polynomial, which a Gauss-Legendre rule of half the depth integrates exactly.

    Going down, a node extends the product of its path by its edge (an edge of a feature that the
    path has already replaces that one's factor by the one of both). Coming up, the sums of value times
    product over the leaves below an edge are unwound of its factor; if it replaced another, they are
    taken out of that one's part. A node costs a few operations a point of the rule.
    """
    out = np.zeros_like(x)
    for root in forest.roots.tolist():
        points, weights = np.polynomial.legendre.leggauss(max(1, -(-forest.depth(root) // 2)))
        t, weights = ((points + 1) / 2)[:, None], weights / 2
        for first in range(0, len(x), ROWS):
            _walk(forest, root, x[first : first + ROWS], t, weights, out[first : first + ROWS])
    return out


def _walk(forest: Forest, root: int, x: np.ndarray, t: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
    def below(node: int, product: np.ndarray, edges: dict) -> np.ndarray:
        """Value times product over the leaves below, at each point; ``edges``: feature -> (z, o, factor)."""
        f = int(forest.feature[node])
        if f < 0:
            return product * forest.value[node]
        goes_left = forest.goes_left(x[:, f], node)
        before = edges.get(f)
        total = 0.0
        for child, passes in ((int(forest.left[node]), goes_left), (int(forest.right[node]), ~goes_left)):
            z, o = max(float(forest.cover[child] / forest.cover[node]), TINY), passes.astype(float)
            if before is not None:
                z, o = z * before[0], o * before[1]
            factor = z * (1 - t) + o * t
            onward = product * factor if before is None else product / before[2] * factor
            sums = below(child, onward, {**edges, f: (z, o, factor)})
            part = (o - z) * (weights @ (sums / factor))
            if before is not None:
                part -= (before[1] - before[0]) * (weights @ (sums / before[2]))
            out[:, f] += part
            total = total + sums
        return total

    below(root, np.ones((len(t), len(x))), {})


#: The least cover share of an edge; only edges that no training row passed have less.
TINY = 1e-12


def expected_margin(forest: Forest) -> float:
    """The margin of no row in particular: every leaf by the share of training rows in it."""
    total = 0.0
    for root in forest.roots.tolist():
        open_ = [(root, 1.0)]
        while open_:
            node, share = open_.pop()
            if forest.feature[node] < 0:
                total += forest.value[node] * share
            else:
                for child in (int(forest.left[node]), int(forest.right[node])):
                    open_.append((child, share * float(forest.cover[child] / forest.cover[node])))
    return total


def tree_attribution(df: DataFrame, key: str, features: Sequence[str], model) -> DataFrame:
    """(key, one column per feature): attributions to the margin of a boosted ensemble.

    With ``expected_margin`` they add up to the margin (the raw score of the positive
    class). The node table is broadcast as arrays; ``model`` may be such arrays already.
    """
    names = list(features)
    shared = df.sparkSession.sparkContext.broadcast(model if isinstance(model, Forest) else forest_of(model))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            out = pd.DataFrame(path_shapley(x, shared.value), columns=names)
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    schema = f"{key} bigint, " + ", ".join(f"`{n}` double" for n in names)
    return df.select(key, *names).mapInPandas(explain, schema)


def top_parts(df: DataFrame, key: str, parts: dict[str, str], k: int = 3) -> DataFrame:
    """(key, rank, feature, value, direction): the k largest parts of each row by size.

    ``parts`` maps a feature to the column with its part of the score.
    """
    entries = []
    for f, column in parts.items():
        v = r6(F.col(f"`{column}`"))
        entries.append(
            F.struct((-F.abs(v)).alias("size"), F.lit(f).alias("feature"), v.alias("value"),
                     direction_text(v).alias("direction"))
        )
    best = F.slice(F.array_sort(F.array(*entries)), 1, k)
    return df.select(key, F.posexplode(best).alias("pos", "e")).select(
        key, (F.col("pos") + 1).alias("rank"), "e.feature", "e.value", "e.direction"
    )


def to_long(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in features]
    return df.select(key, F.inline(F.array(*entries)))
