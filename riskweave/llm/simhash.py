"""SimHash near-duplicates, linked by searches in BK-trees.

Fingerprint: words of the text (A-Z as a-z) in shingles, XXH64 of each shingle, and a bit for
every position that is set in over half the hashes. Two texts link if their fingerprints
differ in ``radius`` bits or fewer; a component is what links reach.

Links are found on distinct fingerprints. With ``radius`` bits different, some blocks of the
64 bits are equal, so fingerprints that can link share a key made of equal blocks. A shard is
the set of fingerprints of one key, cut into chunks of bounded size; every pair of chunks of a
shard is one group, in which the fingerprints of one chunk form a BK-tree (children keyed by
their Hamming distance to the parent) and those of the other search it, following only edges
within the radius. A group returns a star for each set it has linked, never its pairs, and
the stars of all groups are joined to components. A node is named by its least doc_id (and its
fingerprint), so that the least node of a component carries its name.

Defined cases: null and white-space texts have fingerprint zero and link like any other;
texts with fewer words than a shingle are one shingle; repeated rows have one fingerprint and
component; rows without id take part, but give no component its name (a component of such
rows alone has a null component_id); an empty table gives no rows; very long texts are hashed whole,
a bounded number of shingles at a time.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import append_columns
from riskweave.llm.graph import components, hot_join
from riskweave.session import stored

WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a chunk of a shard, about; a group holds two chunks.
CHUNK = 4_096
#: Searches of a group that run at once; bounds the links held before they are merged.
SEARCHES = 256
#: Stands for a missing doc_id among names.
NO_ID = np.iinfo(np.int64).max


def fingerprint(text: str | bytes | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of one text."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    parts = raw.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n > words:
        starts, ends = starts[: n - words + 1].tolist(), ends[words - 1 :].tolist()
    else:
        starts, ends = [0], [len(joined)]
    total = np.zeros(64, np.int64)
    for first in range(0, len(starts), 1 << 16):
        last = first + (1 << 16)
        shingles = [joined[a:b] for a, b in zip(starts[first:last], ends[first:last], strict=True)]
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    set_ = total * 2 > len(starts)
    return int(np.packbits(set_, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, name: str = "fp", words: int = WORDS) -> DataFrame:
    """``docs`` with the fingerprint of text as a signed long."""

    def make():
        def fn(texts):
            out = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in texts]
            return (pa.array(np.array(out, np.uint64).view(np.int64)),)

        return fn

    return append_columns(docs, make, [T.StructField(name, T.LongType())], ["text"])


def layout(n: int, radius: int) -> tuple[list[int], int]:
    """Block widths and how many blocks a key takes, so that a shard has about a chunk at most."""
    for equal in range(1, 5):
        blocks = radius + equal
        if n >> (64 * equal // blocks) <= CHUNK // 4:
            break
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)], equal


def _keys(fp: Column, widths: list[int], equal: int) -> Column:
    """All keys of a fingerprint: each choice of ``equal`` blocks, and their bits."""
    low = [sum(widths[:i]) for i in range(len(widths))]
    out = []
    for at, pick in enumerate(combinations(range(len(widths)), equal)):
        bits = sum(widths[i] for i in pick)
        key = F.lit(0).cast("long")
        for i in pick:
            part = F.shiftrightunsigned(fp, low[i]).bitwiseAND(F.lit((1 << widths[i]) - 1))
            key = F.shiftleft(key, widths[i]).bitwiseOR(part)
        out.append(key.bitwiseOR(F.lit(at << bits).cast("long")))
    return F.array(*out)


def _groups(nodes: DataFrame, keys: Column) -> DataFrame:
    """(key, a, b, side, node, fp): the members of each pair of chunks of each shard."""
    keyed = nodes.withColumn("key", F.explode(keys))
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK), "large-shards")
    large = sizes.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    placed = keyed.withColumn("chunks", F.lit(1))
    if not sizes.isEmpty():
        total = keyed.count()
        placed = hot_join(keyed, large, "key", total, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "fp",
    )


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distance of rows of lanes."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


class Forest:
    """BK-trees of several groups at once, as arrays: child[node, distance]."""

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        """``fps``: a row of lanes each; ``group`` must be sorted: 0, 1, ... without gaps."""
        self.fps, self.edges = fps, 64 * fps.shape[1] + 1
        self.child = np.full((len(fps), self.edges), -1, np.int32)
        self.root = np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0)).astype(np.int64)
        flat = self.child.reshape(-1)
        rest = np.setdiff1d(np.arange(len(fps)), self.root)
        parent = self.root[group[rest]]
        while len(rest):
            slot = parent * self.edges + _far(fps[rest], fps[parent])
            slots, first = np.unique(slot, return_index=True)
            flat[slots] = rest[first]
            going = np.ones(len(rest), bool)
            going[first] = False
            parent, rest = flat[slot[going]].astype(np.int64), rest[going]
        self.has_child = (self.child >= 0).any(axis=1)

    def search(self, group: np.ndarray, fps: np.ndarray, radius: int):
        """(query, node) pairs of one group within the radius."""
        query, node = np.arange(len(fps)), self.root[group]
        found = []
        while len(query):
            d = _far(fps[query], self.fps[node])
            near = d <= radius
            found.append((query[near], node[near]))
            steps = []
            parents = self.has_child[node]
            query, node, d = query[parents], node[parents], d[parents]
            for edge in range(-radius, radius + 1):
                to = d + edge
                ok = (to >= 0) & (to < self.edges)
                next_ = self.child[node[ok], to[ok]]
                has = next_ >= 0
                steps.append((query[ok][has], next_[has].astype(np.int64)))
            query, node = (np.concatenate(x) for x in zip(*steps, strict=True))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of all pairs (a, b); ``label`` maps a place to the least place of its set."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def link_groups(group: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int):
    """Stars (row, root row) of what the groups link; ``group`` is sorted, 0, 1, ...

    A group with one side searches itself; else side 1 searches the tree of side 0.
    """
    two = np.zeros(group[-1] + 1, bool)
    two[group[side == 1]] = True
    inside = np.flatnonzero(side == 0)
    # Groups without a tree have nothing to search.
    has_tree = np.zeros(group[-1] + 1, bool)
    has_tree[group[inside]] = True
    number = np.cumsum(has_tree) - 1
    forest = Forest(number[group[inside]], fps[inside])
    asks = np.flatnonzero(has_tree[group] & np.where(two[group], side == 1, True))
    label = np.arange(len(fps))
    start = np.searchsorted(group, np.arange(group[-1] + 1))
    while len(asks):
        part, asks = asks[:SEARCHES], asks[SEARCHES:]
        q, node = forest.search(number[group[part]], fps[part], radius)
        _merge(label, part[q], inside[node])
        # A group that is one set already has nothing to find.
        open_ = np.maximum.reduceat(label, start) != np.minimum.reduceat(label, start)
        asks = asks[open_[group[asks]]]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(u, v) stars, as structs (id, fp), that connect ``nodes`` (id, fp) within the radius."""
    kind = pa.struct([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        held = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            # The last group may go on in the next batch.
            last = (rows[:3] == rows[:3, -1:]).all(axis=0)
            held, done = rows[:, last], rows[:, ~last]
            if done.shape[1]:
                yield solve(done)
        if held is not None and held.shape[1]:
            yield solve(held)

    def solve(rows):
        new = np.concatenate(([False], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)))
        fps = np.ascontiguousarray(rows[5:].T).view(np.uint64)
        pairs = link_groups(np.cumsum(new), rows[3], fps, radius)
        ends = [pa.StructArray.from_arrays([pa.array(rows[4, x]), pa.array(rows[5, x])], fields=list(kind)) for x in pairs]
        return pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    widths, equal = layout(nodes.count(), radius)
    dealt = _groups(nodes, _keys(F.col("fp"), widths, equal))
    dealt = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    node = "struct<id:bigint,fp:bigint>"
    return dealt.mapInArrow(run, f"u {node}, v {node}")


def classes(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, n, component_id) of the distinct fingerprints of ``marked`` (doc_id, fp); n counts rows."""
    named = marked.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("id"), F.count(F.lit(1)).alias("n"))
    nodes = stored(named, "nodes")
    roots = components(links(nodes.select("id", "fp"), radius)).select("u.fp", F.col("root.id").alias("root"))
    name = F.coalesce("root", "id")
    return nodes.join(roots, "fp", "left").select("fp", "n", F.when(name != NO_ID, name).alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    marked = stored(fingerprints(docs.select("doc_id", "text"), "fp", words).select("doc_id", "fp"), "marks")
    found = stored(classes(marked, radius), "classes")
    return hot_join(marked, found, "fp", marked.count()).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
