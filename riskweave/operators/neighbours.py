"""Exact nearest neighbours, in few columns and in many.

Distinct vectors are searched, each once, however many rows have it. They are dealt into cells of a
tree that is cut from a bounded sample (it decides balance only), and stored in the order of their
cells, in as many files as the work asks for. Each vector first searches its own cell, which gives a
distance that k others keep. Then vectors are asked in bounded blocks against all, in a few rounds
that each see eight times as many: a task goes through its part cell by cell, skips
groups and vectors for which the cell's box lies beyond the distance they have, looks at the others by
blocked products, and computes exact distances where those leave a chance. Each round lowers the
distances for the next, so it returns a few times k a vector, however many there are. Neither
visits nor pairs are written; what is stored besides the vectors is k rows a vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.lookup import State, lookup_join
from riskweave.session import stored

# Rows of a cell, about; rows of the sample that the tree is cut from; bytes of the vectors asked at once.
LEAF_ROWS, SAMPLE_ROWS, BLOCK_BYTES = 1_000, 50_000, 64 << 20
# Vectors whose products with a cell are computed at once; bytes of the vectors in a file of cells, at most about.
BLOCK, FILE_BYTES = 512, 32 << 20
# A round sees so many times the vectors that all before have seen.
GROWTH = 8
# Share of the squared norms by which products may be off.
SLACK = 1e-11


@dataclass
class Tree:
    """Inner nodes split ``axis`` at ``value`` (below it goes left); axis -1 is a leaf."""

    axis: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def cut(cls, sample: np.ndarray, leaf_rows: float) -> Tree:
        nodes: list[list] = []

        def grow(x: np.ndarray) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1])
            spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(1)
            if len(x) > max(leaf_rows, 1) and spread.max() > 0:
                axis = int(spread.argmax())
                value = float(np.median(x[:, axis]))
                if not (x[:, axis] < value).any():
                    value = float(x[x[:, axis] > value, axis].min())
                below = x[:, axis] < value
                nodes[at] = [axis, value, grow(x[below]), grow(x[~below])]
            return at

        grow(sample)
        return cls(*(np.array(c) for c in zip(*nodes)))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            open_ = self.axis[node] >= 0
            if not open_.any():
                return node
            at = node[open_]
            below = x[rows[open_], self.axis[at]] < self.value[at]
            node[open_] = np.where(below, self.left[at], self.right[at])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, summed feature by feature."""
    d2 = np.zeros(len(a))
    for f in range(a.shape[1]):
        d2 += (a[:, f] - b[:, f]) ** 2
    return d2


class Search:
    """The ``k`` nearest points of each asked vector, among the points seen so far.

    ``reach`` has squared distances that k points are known to keep; farther ones are not wanted.
    Asked vectors that follow each other should lie near each other: boxes are taken of ``BLOCK`` at a time.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, reach: np.ndarray, k: int):
        self.ids, self.vectors, self.reach, self.k = ids, vectors, reach.copy(), k
        self.firsts = np.arange(0, len(vectors), BLOCK)
        if len(vectors):
            self.low, self.high = (f.reduceat(vectors, self.firsts, axis=0) for f in (np.minimum, np.maximum))
        self.held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.fresh: list[tuple] = []
        self.many = self.looked = 0

    def add(self, keys: np.ndarray, x: np.ndarray, names: np.ndarray | None = None) -> None:
        """Search the points of one cell; ``names`` tell points apart whose keys are equal."""
        if not len(self.vectors) or not len(x):
            return
        names = keys if names is None else names
        low, high = x.min(axis=0), x.max(axis=0)
        apart = np.maximum(np.maximum(low - self.high, self.low - high), 0.0)
        open_ = (apart**2).sum(axis=1) * (1 - 1e-9) <= np.maximum.reduceat(self.reach, self.firsts)
        # Distances from the middle of the cell keep the norms, and so the slack, small.
        middle = low + (high - low) / 2
        middle[~np.isfinite(middle)] = 0.0
        moved = x - middle
        norms = (moved**2).sum(axis=1)
        points = np.column_stack([moved, norms * ((SLACK - 1) / 2)]).T
        for first in self.firsts[open_]:
            of = np.arange(first, min(first + BLOCK, len(self.vectors)))
            apart = np.maximum(np.maximum(low - self.vectors[of], self.vectors[of] - high), 0.0)
            of = of[(apart**2).sum(axis=1) * (1 - 1e-9) <= self.reach[of]]
            if not len(of):
                continue
            self.looked += len(of) * len(x)
            asked = self.vectors[of] - middle
            own = (asked**2).sum(axis=1)
            # Twice this, taken from the vector's squared norm, is the squared distance less the slack of the point.
            near = np.column_stack([asked, np.ones(len(of))]) @ points
            least = (own * (1 - SLACK) - self.reach[of]) / 2
            chance = near >= least[:, None]
            full = np.flatnonzero(np.count_nonzero(chance, axis=1) > 4 * self.k)
            if len(full) and len(x) > self.k:
                # Many are left: k of them keep the k-th distance by products, and the slack.
                bound = np.partition(np.nan_to_num(near[full], nan=-np.inf), len(x) - self.k, axis=1)[:, len(x) - self.k]
                bound = own[full] - 2 * bound + 2 * SLACK * (own[full] + norms.max())
                lower = np.fmin(self.reach[of[full]], bound)
                self.reach[of[full]] = lower
                chance[full] = near[full] >= ((own[full] * (1 - SLACK) - lower) / 2)[:, None]
            a, b = np.divmod(np.flatnonzero(chance), len(x))
            d2 = squared(self.vectors[of[a]], x[b])
            good = d2 <= self.reach[of[a]]
            self.fresh.append((of[a[good]], keys[b[good]], d2[good], names[b[good]]))
            self.many += int(good.sum())
            if self.many > max(1 << 14, len(self.held[0])):
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(asked, key, squared distance) of the nearest points, ties by key."""
        of, keys, d2, names = (np.concatenate(c) for c in zip(self.held, *self.fresh))
        order = np.lexsort((names, keys, d2, of))
        of, keys, d2, names = of[order], keys[order], d2[order], names[order]
        new = np.concatenate(([True], of[1:] != of[:-1])) if len(of) else np.empty(0, bool)
        rank = np.arange(len(of)) - np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
        kept = rank < self.k
        of, keys, d2, names, rank = of[kept], keys[kept], d2[kept], names[kept], rank[kept]
        last = rank == self.k - 1
        self.reach[of[last]] = np.minimum(self.reach[of[last]], d2[last])
        self.held, self.fresh, self.many = (of, keys, d2, names), [], 0
        return of, keys, d2


def cell_runs(batches, width: int):
    """(cell, vids, keys, vectors) of each run of rows of one cell, over the borders of batches."""
    held: list[tuple] = []
    size = 0

    def flush():
        return held[0][0], *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3))

    for batch in batches:
        cell, vids, keys = (batch.column(i).to_numpy() for i in range(3))
        x = np.column_stack([batch.column(3 + i).to_numpy() for i in range(width)]) if len(batch) else np.empty((0, width))
        ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)) if len(cell) else []
        first = 0
        for end in ends:
            if held and (held[0][0] != cell[first] or size >= 4 * LEAF_ROWS):
                yield flush()
                held, size = [], 0
            held.append((cell[first], vids[first:end], keys[first:end], x[first:end]))
            size += end - first
            first = end
    if held:
        yield flush()


def _cells(vectors: DataFrame, key: str, features: list[str]) -> tuple[DataFrame, int]:
    """The vectors in the order of their cells (cell, vid, key, features, rest), and their number; ``vid`` follows that order."""
    spark = vectors.sparkSession
    n = vectors.count()
    share = int((1 << 30) * min(1.0, SAMPLE_ROWS / max(n, 1)))
    sample = vectors.filter(F.pmod(F.xxhash64(*features), F.lit(1 << 30)) < share).select(*features).toPandas()
    tree = Tree.cut(sample.to_numpy(dtype=float).reshape(-1, len(features)), LEAF_ROWS * len(sample) / max(n, 1))
    cut = spark.sparkContext.broadcast(tree)

    def place(batches):
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy() for i in range(len(features))])
            yield pa.RecordBatch.from_arrays([pa.array(cut.value.leaf_of(x)), *batch.columns], names=["leaf", *batch.schema.names])

    rest = [c for c in vectors.columns if c not in (key, *features)]
    rows = vectors.select(*features, key, *rest)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    located = stored(rows.mapInArrow(place, "leaf bigint, " + types), "leaves")
    # The tree has as many leaves as its sample has rows, at most; large ones are divided.
    leaves = located.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF_ROWS)).alias("parts"))
    cell = F.col("leaf") * F.lit(1 << 32) + F.pmod(F.xxhash64(*features, F.lit("cell")), F.col("parts"))
    dealt = located.join(F.broadcast(leaves), "leaf").select(cell.alias("cell"), key, *features, *rest)
    # Work goes with pairs, not with bytes: files for all cores, and no large ones.
    files = max(2 * spark.sparkContext.defaultParallelism, n * (len(features) + 2) * 8 // FILE_BYTES)
    ordered = dealt.repartition(max(1, min(files, n // LEAF_ROWS)), "cell").sortWithinPartitions("cell")
    placed = ordered.select("cell", F.monotonically_increasing_id().alias("vid"), key, *features, *rest)
    return stored(placed, "cells"), n


def nearest_vectors(vectors: DataFrame, key: str, features: Sequence[str], k: int) -> DataFrame:
    """(features, near): the ``k`` nearest of the vectors for each of them, itself among them, ties by ``key``.

    ``vectors`` has distinct vectors, a key and other columns; an entry of ``near`` has ``d2``, the other
    columns and, as ``row``, the features of the neighbour.
    """
    features = list(features)
    spark, width = vectors.sparkSession, len(features)
    rest = [c for c in vectors.columns if c not in (key, *features)]
    whole, n = _cells(vectors, key, features)
    cells = whole.select("cell", "vid", key, *features)
    found_type = "vid bigint, nb bigint, key bigint, d2 double"

    def as_rows(search: Search) -> pa.RecordBatch:
        of, keys, d2 = search.settle()
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (search.ids[of], search.held[3], keys, d2)], names=["vid", "nb", "key", "d2"]
        )

    def own_cell(batches):
        for _, vids, keys, x in cell_runs(batches, width):
            search = Search(vids, x, np.full(len(x), np.inf), k)
            search.add(keys, x, vids)
            yield as_rows(search)

    own = stored(cells.mapInArrow(own_cell, found_type), "nearest")
    blocks = max(1, -(-n * (width + 2) * 8 // BLOCK_BYTES))
    rounds = 0
    while GROWTH ** (rounds + 1) * LEAF_ROWS <= n:
        rounds += 1
    # The share of vectors that a round adds.
    turn = F.pmod(F.xxhash64("vid", F.lit("turn")), F.lit(GROWTH**rounds))
    parts = []
    for block in range(blocks):
        in_block = F.pmod(F.xxhash64("vid", F.lit("block")), F.lit(blocks)) == block
        best = own.filter(in_block)
        asked = cells.filter(in_block).select("vid", *features).toArrow().sort_by("vid")
        ids = asked["vid"].to_numpy()
        x = np.column_stack([asked[f].to_numpy() for f in features]) if len(ids) else np.empty((0, width))
        for r in range(rounds + 1 if len(ids) else 0):
            last = best.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2")).filter(F.col("n") == k)
            last = last.select("vid", "d2").toArrow()
            reach = np.full(len(ids), np.inf)
            reach[np.searchsorted(ids, last["vid"].to_numpy())] = last["d2"].to_numpy()
            shared = spark.sparkContext.broadcast((ids, x, reach))

            def scan(batches, shared=shared):
                search = Search(*shared.value, k)
                for _, vids, keys, points in cell_runs(batches, width):
                    search.add(keys, points, vids)
                yield as_rows(search)

            these = cells.filter((turn >= (GROWTH ** (r - 1) if r else 0)) & (turn < GROWTH**r))
            both = best.unionByName(these.mapInArrow(scan, found_type)).repartition("vid").distinct()
            order = Window.partitionBy("vid").orderBy("d2", "key", "nb")
            best = stored(both.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= k).drop("pos"), "nearest")
        parts.append(best)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # The columns of the neighbours; a vector that is near to very many is a hot key.
    uses = found.groupBy("nb").agg(F.count(F.lit(1)).alias("_uses"))
    used = whole.select(F.col("vid").alias("nb"), *rest, F.struct(*features).alias("row")).join(uses, "nb")
    listed = lookup_join(found.select("vid", "d2", "nb"), State.of(used, "nb", "_uses"), "vid")
    near = listed.groupBy("vid").agg(F.collect_list(F.struct("d2", *rest, "row")).alias("near"))
    return whole.select("vid", *features).join(near, "vid").drop("vid")
