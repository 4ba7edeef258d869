"""Hard negatives by threshold joins with an inverted index, after L2AP.

Components are quantised to integers, so that scores (inner products) are exact. For each anchor,
its positives are the best rows of its own label; for each positive, the negatives are the best rows
of other labels with a score from ``LOW`` percent of the positive's up to the positive's own.

Both are searches for the first ``k`` rows of a window: a row belongs to the window of an
anchor if its score lies between two bounds. A join finds them: every task goes through its
rows in slices and builds an inverted index of each. A dimension of a row is left out of the index
as long as the norm of the row up to it, times that of any anchor asked, stays below the
lower bound: those dimensions alone reach no window. (Rows are ordered by the number of
dimensions left out, so that the list of a dimension is a run of rows.) Partial scores are
accumulated list by list from the last dimension on; after each group of lists, pairs go whose
partial score and remaining norms (Cauchy-Schwarz) stay below the bound. The score of the
others is then taken exactly in integers. Within a task, a full window raises its bound to its k-th
score. Between joins, bounds are lowered for the windows that are not full yet, until they are or the
bound is the window's own.

Rows are never shuffled or paired: anchors are asked in blocks of about ``BLOCK_BYTES``, read one
block at a time, and a task returns at most k rows a window. Only those are shuffled.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no
part; components of shorter vectors count as zero beyond their end; quantised components beyond
2**27 in size count as that, so that scores of up to 512 dimensions fit a long; rows that
repeat a vec_id are candidates each, but none for an anchor of their id, and one anchor (the
least in label and components); rows without vec_id are candidates, after all others of
their score; fewer rows than asked for give fewer; an empty table gives none. Further columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import stored

POSITIVES = 5
NEGATIVES = 5
#: Negatives score at least this percentage of their positive.
LOW = 80
SCALE = 256
LIMIT = 1 << 27
#: Bytes of the anchors that are asked at once, about; cells of a tile of partial scores.
BLOCK_BYTES = 4 << 20
TILE = 1 << 20
#: Dimensions whose lists are accumulated between two prunings.
GROUP = 16
#: Lower bounds tried for positives, as shares of the largest possible score, and for negatives, as
#: percentages of the positive's.
POSITIVE_BOUNDS = (0.6, 0.3, 0.0)
NEGATIVE_BOUNDS = (95, 88)

NONE = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


def quantised(rows: DataFrame, label: Column | None = None, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, q) of the rows that take part; ``label`` replaces the column label."""
    label = F.col("label") if label is None else label
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(
        vector,
        lambda x: F.greatest(
            F.least(F.floor(x.cast("double") * SCALE).cast("double"), F.lit(float(LIMIT))), F.lit(float(-LIMIT))
        ).cast("int"),
    )
    out = rows.select("vec_id", label.cast("long").alias("label"), vector)
    return out.filter(F.col("label").isNotNull() & F.col(vector).isNotNull() & ~odd).select("vec_id", "label", whole.alias("q"))


@dataclass
class Anchors:
    """A block of anchors: ids, labels and a row of components each."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


@dataclass
class Windows:
    """Windows, those of an anchor next to each other: its place, bounds of the score, its own label or others."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool

    def take(self, which: np.ndarray, low: np.ndarray) -> Windows:
        return Windows(self.anchor[which], low, self.high[which], self.same)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A row of components for each list, with zeros at the end of shorter ones."""
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    sizes = np.diff(at)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(at[:-1] - at[0], sizes)] = flat
    return out


class Index:
    """The inverted index of a slice of rows, for scores of ``least`` or more times an anchor's norm."""

    def __init__(self, rows: np.ndarray, least: float):
        norms = np.sqrt(np.cumsum(rows**2, axis=1))
        out = (norms < least).sum(axis=1)
        #: The rows in the order of how many dimensions are left out; those that reach nothing are last.
        self.order = np.argsort(out, kind="stable")
        self.rows, self.out = rows[self.order], out[self.order]
        self.norms = np.concatenate([np.zeros((len(rows), 1)), norms[self.order]], axis=1)
        width = rows.shape[1]
        self.size = int(np.searchsorted(self.out, width, "left"))
        self.held = np.where(np.arange(width) >= self.out[:, None], self.rows, 0.0)

    def candidates(self, anchors: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) pairs whose score can be ``low[anchor]`` or more."""
        width, size = anchors.shape[1], self.size
        if not size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        before = np.concatenate([np.zeros((len(anchors), 1)), np.sqrt(np.cumsum(anchors**2, axis=1))], axis=1)
        slack = 1e-9 * (1.0 + before[:, -1:] * self.norms[: max(size, 1), -1].max(initial=0.0))
        bound = low[:, None] - slack
        partial = np.zeros((len(anchors), size))
        a = r = None  # pairs, once few are left
        for end in range(width, 0, -GROUP):
            first = max(0, end - GROUP)
            # Rows with a dimension before ``end`` in the index are a run from the first on.
            n = int(np.searchsorted(self.out[:size], end, "left"))
            if a is None:
                partial[:, :n] += anchors[:, first:end] @ self.held[:n, first:end].T
                # What is open: dimensions before ``first``, or those never indexed.
                open_ = np.maximum(self.out[:size], first)
                left = self.norms[np.arange(size), open_]
                if first and first > width // 2:
                    continue
                alive = partial + before[:, open_] * left >= bound
                if not first or alive.mean() < 0.1:
                    a, r = np.nonzero(alive)
                    score = partial[a, r]
            else:
                score = score + np.einsum("ij,ij->i", anchors[a, first:end], self.held[r, first:end])
                open_ = np.maximum(self.out[r], first)
                alive = score + before[a, open_] * self.norms[r, open_] >= bound[a, 0]
                a, r, score = a[alive], r[alive], score[alive]
        return a, r


def exact(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The integer score of each pair."""
    out = np.empty(len(a), np.int64)
    step = max(1, TILE // max(anchors.shape[1], 1))
    for i in range(0, len(a), step):
        x, y = anchors[a[i : i + step]].astype(np.int64), rows[r[i : i + step]].astype(np.int64)
        out[i : i + step] = np.einsum("ij,ij->i", x, y)
    return out


def first_of(window: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each window: by score, then by smaller id."""
    order = np.lexsort((ids, -score, window))
    sorted_ = window[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1]))) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


class Search:
    """The first ``k`` rows of each window among the rows seen so far."""

    def __init__(self, anchors: Anchors, windows: Windows, k: int):
        self.anchors, self.windows, self.k = anchors, windows, k
        self.low = windows.low.copy()
        # Windows of an anchor are next to each other.
        self.at = np.searchsorted(windows.anchor, np.arange(len(anchors.ids) + 1))
        self.asked = np.flatnonzero(np.diff(self.at))
        self.norm = np.sqrt((anchors.vectors**2).sum(axis=1))
        self.window = self.ids = self.score = np.empty(0, np.int64)
        self.fresh, self.many = [], 0

    def least(self) -> np.ndarray:
        """The lowest bound of each anchor that is asked."""
        return np.minimum.reduceat(self.low, self.at[self.asked]).astype(np.float64)

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        if not len(self.asked) or not len(rows):
            return
        for first in range(0, len(rows), 2048):
            self._slice(*(x[first : first + 2048] for x in (ids, labels, rows)))

    def _slice(self, ids, labels, rows) -> None:
        low = self.least()
        norm = self.norm[self.asked]
        # An anchor without length, or a bound that all reach, leaves nothing out.
        reach = np.where(low <= 0, 0.0, low / np.maximum(norm, 1e-300))
        index = Index(rows, float(reach.min()) * (1 - 1e-9))
        step = max(1, TILE // len(rows))
        for first in range(0, len(self.asked), step):
            part = slice(first, first + step)
            a, r = index.candidates(self.anchors.vectors[self.asked[part]], low[part])
            a, r = self.asked[part][a], index.order[r]
            fits = ((self.anchors.labels[a] == labels[r]) == self.windows.same) & (self.anchors.ids[a] != ids[r])
            self._take(a[fits], ids[r[fits]], exact(self.anchors.vectors, rows, a[fits], r[fits]))

    def _take(self, a, ids, score) -> None:
        many = self.at[a + 1] - self.at[a]
        pair = np.repeat(np.arange(len(a)), many)
        window = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + self.at[a][pair]
        score = score[pair]
        inside = (score >= self.low[window]) & (score <= self.windows.high[window])
        self.fresh.append((window[inside], ids[pair][inside], score[inside]))
        self.many += int(inside.sum())
        if self.many > max(1 << 15, len(self.window)):
            self.settle()

    def settle(self) -> None:
        """Keep the first ``k`` of each window; a full one asks for its last score at least."""
        held = [(self.window, self.ids, self.score), *self.fresh]
        window, ids, score = (np.concatenate(x) for x in zip(*held, strict=True))
        kept = first_of(window, ids, score, self.k)
        self.window, self.ids, self.score, self.fresh, self.many = window[kept], ids[kept], score[kept], [], 0
        ends = np.flatnonzero(np.append(self.window[1:] != self.window[:-1], True)) if len(kept) else kept
        full = np.diff(np.concatenate(([-1], ends))) == self.k
        self.low[self.window[ends[full]]] = self.score[ends[full]]


def join(points: DataFrame, width: int, anchors: Anchors, windows: Windows, k: int) -> DataFrame:
    """(w, vec_id, score, rank): the first ``k`` rows of each window; vec_id is NONE for a missing one."""
    shared = points.sparkSession.sparkContext.broadcast((anchors, windows))

    def run(batches):
        search = Search(*shared.value, k)
        for batch in batches:
            ids = batch.column(0).fill_null(NONE).to_numpy()
            labels, lists = batch.column(1).to_numpy(), batch.column(2)
            rows = max(1, TILE // max(width, 1))
            for i in range(0, len(batch), rows):
                search.add(ids[i : i + rows], labels[i : i + rows], matrix(lists.slice(i, rows), width))
        search.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (search.window, search.ids, search.score)], names=["w", "vec_id", "score"]
        )

    found = points.select("vec_id", "label", "q").mapInArrow(run, "w long, vec_id long, score long")
    order = Window.partitionBy("w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fill(points: DataFrame, width: int, anchors: Anchors, windows: Windows, k: int, bounds: list[np.ndarray]) -> DataFrame:
    """(w, vec_id, score, rank) of all windows: bounds are lowered until each is full or at its own."""
    open_ = np.arange(len(windows.anchor))
    parts = []
    for bound in [*bounds, windows.low]:
        if not len(open_):
            break
        low = np.maximum(bound[open_], windows.low[open_])
        found = join(points, width, anchors, windows.take(open_, low), k)
        found = stored(found, "windows")
        sizes = found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).toArrow()
        n = np.zeros(len(open_), np.int64)
        n[sizes["w"].to_numpy()] = sizes["n"].to_numpy()
        done = (n == k) | (low == windows.low[open_])
        names = points.sparkSession.createDataFrame(pa.table({"w": np.flatnonzero(done), "_w": open_[done]}))
        parts.append(found.join(F.broadcast(names), "w").select(F.col("_w").alias("w"), "vec_id", "score", "rank"))
        open_ = open_[~done]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def blocks(points: DataFrame, is_anchor: Column, width: int) -> Iterator[Anchors]:
    """The anchors, one of each id, in blocks."""
    asked = points.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("own"))
    asked = stored(asked.select("vec_id", "own.label", "own.q"), "anchors")
    n = asked.count()
    parts = max(1, -(-n * width * 8 // BLOCK_BYTES))
    for b in range(parts if n else 0):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == b).orderBy("vec_id").toArrow().combine_chunks()
        if len(rows):
            yield Anchors(
                rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["q"].chunk(0), width)
            )


def mine(points: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """Hard negatives among ``points`` (vec_id, label, q), for the rows that ``is_anchor`` names by id.

    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``rank`` counts
    the negatives of one positive.
    """
    spark = points.sparkSession
    points = stored(points, "points")
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = points.agg(F.max(F.size("q")).alias("width"), F.sqrt(F.max(square)).alias("norm")).first()
    width, norm = max(most["width"] or 0, 1), most["norm"] or 0.0
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    parts = []
    for anchors in blocks(points, is_anchor & F.col("vec_id").isNotNull(), width):
        n = len(anchors.ids)
        reach = np.sqrt((anchors.vectors**2).sum(axis=1)) * norm
        own = Windows(np.arange(n), np.full(n, LEAST), np.full(n, NONE), True)
        starts = [np.floor(share * reach).astype(np.int64) for share in POSITIVE_BOUNDS]
        best = fill(points, width, anchors, own, positives, starts).orderBy("w", "rank").toArrow()
        top, of = best["score"].to_numpy(), best["w"].to_numpy()
        windows = Windows(of, -(-low * top // 100), top, False)
        starts = [-(-max(share, low) * top // 100) for share in NEGATIVE_BOUNDS]
        if not len(top):
            continue
        # No score lies between bounds of a negative positive score: they are in the wrong order.
        found = fill(points, width, anchors, windows, negatives, [np.minimum(s, top) for s in starts])
        asked = spark.createDataFrame(
            pa.table({"w": np.arange(len(of)), "anchor_id": anchors.ids[of], "positive_id": best["vec_id"], "positive_score": top})
        )
        missing = lambda c: F.when(F.col(c) != NONE, F.col(c))
        parts.append(
            found.join(F.broadcast(asked), "w").select(
                "anchor_id", missing("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                missing("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
            )
        )
    if not parts:
        return spark.createDataFrame([], kind)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


ORACLE = f"""
with points as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor({SCALE} * cast(x as double)) for x in embedding] as q
    from embeddings
    where label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
        cast(list_inner_product(a.q, b.q) as bigint) as score
    from points a join points b on a.vec_id != b.vec_id
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}
)
select p.anchor_id, p.positive_id,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
    s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
    and {LOW} * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify rank <= {NEGATIVES}
"""
