"""Ranked lexical search: exact first documents for each item, with norm buckets after LEMP.

Terms are runs of letters, digits and non-ASCII characters, A-Z as a-z, compared by a 64-bit hash.
The score of a document sums, over the distinct terms of an item, an integer weight (rarer terms
weigh more) times an integer impact (more occurrences and shorter documents count more); see ``weight``
and ``impacts``. Scores are inner products of the item's vector (roots of weights) and the document's
vector over the terms of all items (roots of weights times impacts).

1. One pass over the texts keeps the occurrences of the items' terms, which is what statistics and
   scores need; texts are not read again.
2. Documents are written in order of length (norm) within each task. The longest of all (``SEEDS``
   of them or a ``SEED_SHARE``) are searched first and give each item a score that is reached by the
   wanted number of documents.
3. All others follow, bucket by bucket from long to short. By the Cauchy-Schwarz bound a bucket is
   skipped for an item if the norm of its first document times the item's stays below the
   item's score so far, and documents too short for all items are left out of the scan by the
   statistics of their files. Inside a bucket, the heaviest coordinates of the item give each
   document an interval that its coordinate must lie in, and then a partial score, to which the
   norms of the rest are the most that can be added. Survivors are rescored in integers.
   A task's best scores raise the item's bound.

Items are searched in blocks of about ``BLOCK_TERMS`` terms, read one block at a time, so that
what is broadcast is bounded (one item is never divided). Documents are not shuffled; a task returns
the wanted number of rows an item at most.

Defined cases: null and empty texts have no term, are never found, and do not count as documents;
an item without a term has no rows; texts that share an item_id are one item, also those without one;
rows that repeat a doc_id are documents each; rows without doc_id come last among equal scores; ties
go by doc_id; empty tables give no rows. Texts are read whole. Further columns are not read, whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import PUNCT, chunk_words
from riskweave.session import stored

TOP = 50
#: Terms of the items searched at once, about.
BLOCK_TERMS = 1 << 14
#: Documents searched first: so many, or this share if that is more.
SEEDS, SEED_SHARE = 4_096, 0.01
#: Documents of a bucket, and cells of its table of impacts, at most.
BUCKET = 1_024
CELLS = 1 << 22
#: Coordinates of an item that filter the documents of a bucket.
FOCUS = 4
#: Bounds in floating point are widened by this share.
SLACK = 1e-9

NONE = np.iinfo(np.int64).max


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, size: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Integer impacts of ``tf`` occurrences in texts of ``size`` terms; ``total`` terms in all."""
    m = 50 + (50 * size * documents) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Items:
    """A block of items: names, sorted keys of all their terms, and the places of each item's own."""

    ids: pa.Array
    keys: np.ndarray
    terms: list[np.ndarray]


@dataclass
class Corpus:
    """What scores need besides the document: weights by place of the term, and counts."""

    weights: np.ndarray
    documents: int
    total: int


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, key): the distinct terms of each item."""

    def run(batches):
        for batch in batches:
            for first, end, words, at in chunk_words(batch.column(1), PUNCT):
                row = np.repeat(np.arange(first, end), np.diff(at))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(words.view(np.int64))], names=["item_id", "key"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, key long").distinct()


def blocks(items: DataFrame) -> Iterator[Items]:
    found = stored(item_terms(items), "item-terms")
    parts = max(1, -(-found.count() // BLOCK_TERMS))
    for b in range(parts):
        rows = found.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == b).toArrow().combine_chunks()
        if len(rows):
            coded = rows["item_id"].combine_chunks().dictionary_encode("encode")
            of = coded.indices.to_numpy()
            keys, place = np.unique(rows["key"].to_numpy().view(np.uint64), return_inverse=True)
            order = np.argsort(of, kind="stable")
            yield Items(coded.dictionary, keys, np.split(place[order], np.flatnonzero(np.diff(of[order])) + 1))


def occurrences(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """(doc_id, size, terms, tf) of each text that has a term; ``terms`` are places among ``keys``."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        keys = shared.value
        for batch in batches:
            for first, end, words, at in chunk_words(batch.column(1), PUNCT):
                sizes = np.diff(at)
                place = np.searchsorted(keys, words)
                place[place == len(keys)] = 0
                hit = keys[place] == words
                row = np.repeat(np.arange(end - first), sizes)[hit]
                pair, tf = np.unique(row * len(keys) + place[hit], return_counts=True)
                row, term = pair // len(keys), pair % len(keys)
                some = np.flatnonzero(sizes)
                # Only texts without any term are left out, and those have no pairs.
                offsets = pa.array(np.append(np.searchsorted(row, some), len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first).take(pa.array(some)), pa.array(sizes[some]),
                        pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "size", "terms", "tf"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, size long, terms array<int>, tf array<int>"
    )


def _flat(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each row and the end, terms, impacts) of a batch of occurrences."""
    lists, tf = batch.column("terms"), batch.column("tf")
    at = lists.offsets.to_numpy().astype(np.int64)
    terms = lists.values.to_numpy()[at[0] : at[-1]]
    sizes = np.repeat(batch.column("size").to_numpy(), np.diff(at))
    other = tf.offsets.to_numpy()
    tf = tf.values.to_numpy()[other[0] : other[-1]].astype(np.int64)
    return at - at[0], terms, impacts(tf, sizes, corpus.documents, corpus.total)


def by_length(found: DataFrame, corpus: Corpus) -> DataFrame:
    """``found`` with the norm of each document, longest first in each task; without those of none."""
    shared = found.sparkSession.sparkContext.broadcast(corpus)

    def run(batches):
        c = shared.value
        for batch in batches:
            at, terms, impact = _flat(batch, c)
            square = np.concatenate(([0.0], np.cumsum(c.weights[terms] * impact.astype(np.float64) ** 2)))
            # A difference of sums may be a little too small.
            norm = np.sqrt(np.maximum(square[at[1:]] - square[at[:-1]] + square[-1] * 1e-14, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm)], names=[*batch.schema.names, "norm"])

    rows = found.filter(F.size("terms") > 0)
    schema = "doc_id long, size long, terms array<int>, tf array<int>, norm double"
    return rows.mapInArrow(run, schema).sortWithinPartitions(F.desc("norm"))


class Search:
    """The best documents of each item among those seen so far."""

    def __init__(self, items: Items, corpus: Corpus, bounds: np.ndarray, top: int):
        self.items, self.corpus, self.top = items, corpus, top
        #: Scores below these are not wanted.
        self.bounds = bounds.copy()
        self.weights = [corpus.weights[t] for t in items.terms]
        self.norms = np.sqrt([w.sum() for w in self.weights])
        # The heaviest coordinates come first.
        orders = [np.argsort(-w, kind="stable") for w in self.weights]
        self.terms = [t[o] for t, o in zip(items.terms, orders, strict=True)]
        self.weights = [w[o] for w, o in zip(self.weights, orders, strict=True)]
        self.held: list[list] = [[] for _ in self.terms]
        self.many = np.zeros(len(self.terms), np.int64)

    def add(self, batch: pa.RecordBatch) -> None:
        """Search the documents of a batch, in buckets from long to short."""
        rows = max(1, min(BUCKET, CELLS // len(self.items.keys)))
        norms = batch.column("norm").to_numpy()
        if not (self.norms * norms.max(initial=0.0) * (1 + SLACK) >= self.bounds).any():
            return
        order = np.argsort(-norms, kind="stable")
        at, terms, impact = _flat(batch, self.corpus)
        ids = batch.column("doc_id").fill_null(NONE).to_numpy()
        for first in range(0, len(order), rows):
            part = order[first : first + rows]
            # The bucket's first document is its longest.
            asked = np.flatnonzero(self.norms * norms[part[0]] * (1 + SLACK) >= self.bounds)
            if not len(asked):
                return
            sizes = at[part + 1] - at[part]
            entry = np.arange(sizes.sum()) + np.repeat(at[part] - np.cumsum(sizes) + sizes, sizes)
            table = np.zeros((len(part), len(self.items.keys)), np.int32)
            table[np.repeat(np.arange(len(part)), sizes), terms[entry]] = impact[entry]
            for i in asked:
                self._ask(i, table, norms[part], ids[part])

    def _ask(self, i: int, table: np.ndarray, norms: np.ndarray, ids: np.ndarray) -> None:
        bound, norm, terms, weights = self.bounds[i], self.norms[i], self.terms[i], self.weights[i]
        if not norm:
            return
        # The cosine that a document of this length needs.
        cosine = bound / (norm * norms * (1 + SLACK))
        rows = np.flatnonzero(cosine <= 1)
        cosine, spread = cosine[rows], np.sqrt(1 - cosine[rows] ** 2)
        partial, rest = np.zeros(len(rows)), norms[rows] ** 2 * (1 + SLACK)
        item_rest = norm**2
        for term, w in zip(terms[:FOCUS], weights[:FOCUS], strict=True):
            impact = table[rows, term].astype(np.float64)
            # The unit vector lies within an angle of the item's, so its coordinate lies in an interval.
            own = np.sqrt(w) / norm
            across = spread * np.sqrt(max(0.0, 1 - own**2)) + SLACK
            unit = np.sqrt(w) * impact / norms[rows]
            high = np.where(cosine <= own, 1.0, own * cosine + across)
            partial += w * impact
            rest -= w * impact**2
            item_rest -= w
            most = partial + np.sqrt(np.maximum(rest, 0) * max(item_rest, 0.0)) * (1 + SLACK) + SLACK
            keep = (unit >= own * cosine - across) & (unit <= high + SLACK) & (most >= bound * (1 - SLACK))
            rows, cosine, spread, partial, rest = rows[keep], cosine[keep], spread[keep], partial[keep], rest[keep]
        if not len(rows):
            return
        score = table[np.ix_(rows, terms)].astype(np.int64) @ weights
        good = score >= bound
        if good.any():
            self.held[i].append((ids[rows[good]], score[good]))
            self.many[i] += good.sum()
            if self.many[i] >= 2 * self.top:
                self.settle(i)

    def settle(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The best documents of an item; the last of enough of them is a bound."""
        ids, score = (np.concatenate(x) for x in zip((np.empty(0, np.int64),) * 2, *self.held[i], strict=True))
        best = np.lexsort((ids, -score))[: self.top]
        ids, score = ids[best], score[best]
        if len(best) == self.top:
            self.bounds[i] = max(self.bounds[i], score[-1])
        self.held[i], self.many[i] = [(ids, score)], 0
        return ids, score


def best(rows: DataFrame, items: Items, corpus: Corpus, bounds: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score) of documents among ``rows`` that can be the best of an item, by task."""
    shared = rows.sparkSession.sparkContext.broadcast((items, corpus, bounds))

    def run(batches):
        search = Search(*shared.value, top)
        for batch in batches:
            search.add(batch)
        found = [(i, *search.settle(i)) for i in range(len(search.held))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                *[pa.array(np.concatenate([f[c] for f in found]).astype(np.int64)) for c in (1, 2)],
            ],
            names=["item", "doc_id", "score"],
        )

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """``found`` with the rank within each item, up to ``top``."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search(docs: DataFrame, items: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    found = stored(occurrences(docs, items.keys), "occurrences")
    counts = found.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).first()
    documents, total = counts["n"], counts["total"] or 0
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    weights = np.zeros(len(items.keys), np.int64)
    weights[df["term"].to_numpy()] = [weight(documents, x) for x in df["df"].to_pylist()]
    corpus = Corpus(weights, documents, total)
    rows = stored(by_length(found, corpus), "by-length")

    share = max(SEEDS / max(documents, 1), SEED_SHARE)
    cut = 0.0 if share >= 1 else rows.agg(F.percentile_approx("norm", 1 - share, 10_000)).first()[0] or 0.0
    first = stored(ranked(best(rows.filter(F.col("norm") >= cut), items, corpus, np.ones(len(items.terms), np.int64), top), top), "first")
    bounds = np.ones(len(items.terms), np.int64)
    full = first.filter(F.col("rank") == top).select("item", "score").toArrow()
    bounds[full["item"].to_numpy()] = full["score"].to_numpy()
    norms = np.sqrt([weights[t].sum() for t in items.terms])
    # No item wants what is shorter.
    least = float((bounds / np.maximum(norms, SLACK)).min()) * (1 - SLACK)
    others = rows.filter((F.col("norm") < cut) & (F.col("norm") >= least))
    found = first.drop("rank").union(best(others, items, corpus, bounds, top)) if cut else first.drop("rank")
    names = spark.createDataFrame(pa.table({"item": np.arange(len(items.terms)), "item_id": items.ids}))
    return ranked(found, top).join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != NONE, F.col("doc_id")).alias("doc_id"), "score"
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of ``docs`` with a score, for each of ``items``."""
    parts = [_search(docs.select("doc_id", "text"), block, top) for block in blocks(items)]
    if not parts:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
with asked as (
    select distinct item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) as term from benchmark
), words as (
    select doc_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) as term from documents
), sizes as (
    select doc_id, count(*) as n from words group by doc_id
), total as (
    select count(*) as n, cast(sum(n) as bigint) as l from sizes
), tf as (
    select doc_id, term, count(*) as tf from words where term in (select term from asked) group by doc_id, term
), weights as (
    select term, cast(floor(1000 * ln((2 * t.n + 2) / (2 * count(*) + 1))) as bigint) as w
    from tf, total t group by term, t.n
), scored as (
    select a.item_id, tf.doc_id,
        cast(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * s.n * t.n) // t.l)))) as bigint) as score
    from asked a join tf on a.term = tf.term join weights w on w.term = tf.term
        join sizes s on s.doc_id = tf.doc_id, total t
    group by a.item_id, tf.doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0 qualify rank <= {TOP}
"""
