"""Connected components of an edge table, and joins of rows with hot keys.

Nodes are of any orderable type. Defined cases: an empty table gives an empty one; repeated edges,
edges of both directions and edges of a node with itself (also null ends) change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import stored

#: Edges that one task contracts at once, at most.
LOCAL = 1 << 20
#: Keys with more than this part of all rows are joined by a broadcast; there are at most so many.
HEAVY = 1_000


def hot_join(rows: DataFrame, table: DataFrame, on: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row a key), whose column n has the number of rows of the key.

    Keys with over a ``HEAVY``-th of the ``total`` rows are broadcast, so no key is a large group of
    the shuffle. ``how`` is inner or left.
    """
    other = [c for c in table.columns if c not in (on, "n")]
    heavy = table.filter(F.col("n") * HEAVY > total).select(on, F.struct(*other).alias("_heavy"))
    light = table.filter(F.col("n") * HEAVY <= total).drop("n")
    marked = rows.join(F.broadcast(heavy), on, "left")
    hot = marked.filter("_heavy is not null").select(*rows.columns, *[F.col(f"_heavy.{c}").alias(c) for c in other])
    return hot.union(marked.filter("_heavy is null").drop("_heavy").join(light, on, how).select(hot.columns))


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, least node reached) of the components of some edges; nodes are integers."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = np.split(ends, 2)
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return nodes[moved], nodes[label[moved]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: what a task has, ``LOCAL`` at a time, as stars."""

    def run(batches):
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held)
            ends = pa.concat_arrays([c for name in ("u", "v") for c in table[name].chunks])
            # Numbers in the order of the nodes.
            if pa.types.is_struct(ends.type):
                columns = [ends.field(i).to_numpy(zero_copy_only=False) for i in range(ends.type.num_fields)]
                order = np.lexsort(columns[::-1])
                new = np.zeros(len(order), bool)
                for c in columns:
                    new[1:] |= c[order][1:] != c[order][:-1]
            else:
                column = ends.to_numpy(zero_copy_only=False)
                order = np.argsort(column, kind="stable")
                new = np.concatenate(([False], column[order][1:] != column[order][:-1]))
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(new)
            first = order[np.concatenate(([0], np.flatnonzero(new)))]
            u, v = contract(*np.split(place, 2))
            return pa.RecordBatch.from_arrays([ends.take(pa.array(first[x])) for x in (u, v)], names=["u", "v"])

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size >= LOCAL:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return edges.mapInArrow(run, edges.schema)


def _star(edges: DataFrame, least: DataFrame, total: int, keep: Column) -> DataFrame:
    """(v, least of u) for the edges (u, v) that ``keep`` names."""
    met = hot_join(edges, least, "u", total)
    return met.filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node but the roots; root is the smallest node of the component.

    ``edges`` has two columns u, v. Each task contracts the edges it has to stars. If more than
    ``LOCAL`` are left, rounds of a large-star and a small-star step follow, which take minima by node
    (combined before the shuffle) and give them back to the edges; nodes with a great
    part of all edges get theirs by a broadcast. The edge table is written after every round. Once
    few are left, one task contracts them; else the rounds end when one changes nothing.
    """
    ends = edges.filter("u is not null and v is not null and u != v")
    now = stored(_contracted(ends.select("u", "v")), "edges")
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        n, seen = mark["n"], (mark["n"], mark["h"])
        if n <= LOCAL:
            return _contracted(now.coalesce(1)).withColumnRenamed("v", "root")
        if seen == before:
            return now.withColumnRenamed("v", "root")
        before = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
        large = stored(_star(both, least, 2 * n, F.col("v") > F.col("u")).distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        small = _star(large, least, n, F.col("v") != F.col("m"))
        now = stored(_contracted(least.select("u", F.col("m").alias("v")).union(small)).distinct(), "edges")
