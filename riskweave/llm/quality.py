"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of terms: its frequent words (lower case, without punctuation at the
edges), the shapes of its words (case, punctuation before and after), and how often a word
repeats the one before. Terms are weighted by the square root of their share and by inverse
document frequency, and projected to a latent space by a truncated singular value
decomposition fitted on a bounded labelled sample. The vectors of that sample are broadcast;
each document meets all of them in blocks of exact cosine products, and its nearest
neighbours vote with their similarity as weight.

Defined cases: null and empty texts, and texts of white space, have no vector and score 0.0;
a text without any known term gets the share of label 1 in the sample, halved sample classes
included; repeated rows score alike; neighbours tied in similarity are taken in the order of
doc_id; with no labelled row every score is 0.5 (the vote of nobody); an empty table gives an empty one;
very long texts are counted whole, in chunks.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import append_columns, labelled_sample

#: Labelled documents whose vectors are broadcast, at most: 4,000 x 64 floats are 1 MB.
SAMPLE = 4_000
TERMS = 1_024
LATENT = 64
NEIGHBOURS = 15
REJECT_BELOW = 0.7
#: Documents multiplied with the labelled vectors at once.
BLOCK = 256
MEMORY = 200_000
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\=+~^@`"


def shape(word: str) -> str:
    """Case and edge punctuation of a word, e.g. ``Aa.`` or ``A!!``."""
    left = word.lstrip(EDGES)
    core = left.rstrip(EDGES)
    if not core:
        return "p" + word[:3]
    before, after = word[: len(word) - len(left)][:2], left[len(core) :][:3]
    if not any(c.isalpha() for c in core):
        kind = "0" if any(c.isdigit() for c in core) else "?"
    elif core.islower():
        kind = "a"
    elif core.isupper():
        kind = "A" if len(core) > 1 else "I"
    else:
        kind = "Aa" if core[0].isupper() and core[1:].islower() else "aA"
    return f"{before}{kind}{min(len(core), 24) // 8}{after}"


def terms(word: str) -> tuple[str, str]:
    return "w" + word.strip(EDGES).lower(), "s" + shape(word)


REPEAT = "r"


@dataclass
class QualityModel:
    """Term places, weights, the projection, and the labelled vectors with their labels."""

    place: dict[str, int]
    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def counter(self):
        """A function from a text to its counts by term; the last count is of other terms."""
        none, wide = len(self.place), len(self.place) + 1
        memory: dict[str, int] = {}
        repeat = self.place.get(REPEAT, none)

        def code(word):
            if len(memory) >= MEMORY:
                memory.clear()
            lex, form = terms(word)
            memory[word] = c = self.place.get(lex, none) * wide + self.place.get(form, none)
            return c

        def counts(text):
            words = (text or "").split()
            out = np.zeros(wide, np.float32)
            if words:
                codes = np.array(
                    [c if (c := memory.get(w)) is not None else code(w) for w in words], np.int64
                )
                out += np.bincount(codes // wide, minlength=wide)
                out += np.bincount(codes % wide, minlength=wide)
                out[repeat] += sum(map(operator.eq, words, words[1:]))
            return out, len(words)

        return counts

    def project(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space, zero for texts without known terms."""
        x = np.sqrt(counts[:, :-1] / np.maximum(sizes, 1)[:, None]) * self.weight
        v = x @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def vote(self, v: np.ndarray) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(v), 0.5)
        sims = v.astype(np.float32) @ self.vectors.T
        k = min(NEIGHBOURS, sims.shape[1])
        # Everything above the k-th similarity votes; ties at it are taken in order.
        kth = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
        above = sims > kth[:, None]
        tied = sims == kth[:, None]
        room = k - above.sum(axis=1)
        votes = above | (tied & (np.cumsum(tied, axis=1) <= room[:, None]))
        weight = np.where(votes, np.maximum(sims, 0), 0)
        total = weight.sum(axis=1)
        share = (weight @ self.labels) / np.maximum(total, 1e-12)
        return np.where(total > 0, np.clip(share, 0.0, 1.0), self.labels.mean())


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, n): documents of the sample that have the term."""

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update({t for w in set((text or "").split()) for t in terms(w)})
            if len(counts) > MEMORY:
                yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())})
                counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())})

    return sample.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> QualityModel:
    """Vocabulary, projection and labelled vectors from a bounded sample of labelled texts."""
    sample = labelled_sample(docs, labels, "quality", keep, SAMPLE).filter(F.trim("text") != "")
    best = (
        _term_counts(sample)
        .filter("n >= 3 and term != 'w'")
        .orderBy(F.desc("n"), "term")
        .limit(TERMS - 1)
        .collect()
    )
    place = {r["term"]: i for i, r in enumerate(best)} | {REPEAT: len(best)}
    total = max((r["n"] for r in best), default=1)
    weight = np.array([np.log1p(total / r["n"]) for r in best] + [2.0], np.float32)
    width = len(place)
    empty = QualityModel(place, weight, np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    bare = docs.sparkSession.sparkContext.broadcast(empty)

    def run(batches):
        counts = bare.value.counter()
        for batch in batches:
            found = [counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("y"),
                    pa.array([n for _, n in found], pa.int64()),
                    pa.array([c for c, _ in found], pa.list_(pa.float32())),
                ],
                names=["doc_id", "y", "n", "counts"],
            )

    rows = (
        sample.select("doc_id", "y", "text")
        .mapInArrow(run, "doc_id long, y int, n long, counts array<float>")
        .toArrow()
        .sort_by("doc_id")
    )
    if not rows.num_rows:
        return empty
    counts = rows["counts"].combine_chunks().values.to_numpy().reshape(rows.num_rows, width + 1)
    sizes = rows["n"].to_numpy()
    x = np.sqrt(counts[:, :-1] / np.maximum(sizes, 1)[:, None]) * weight
    # The right singular vectors of x, largest first.
    basis = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :LATENT].astype(np.float32)
    model = QualityModel(place, weight, np.ascontiguousarray(basis), empty.vectors, empty.labels)
    vectors = model.project(counts, sizes).astype(np.float32)
    return QualityModel(place, weight, model.basis, vectors, rows["y"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        counts = m.counter()

        def fn(texts):
            out = np.zeros(len(texts))
            for first in range(0, len(texts), BLOCK):
                found = [counts(t.as_py()) for t in texts[first : first + BLOCK]]
                sizes = np.array([n for _, n in found])
                votes = m.vote(m.project(np.array([c for c, _ in found]), sizes))
                out[first : first + BLOCK] = np.where(sizes > 0, votes, 0.0)
            return (pa.array(out),)

        return fn

    return append_columns(docs, make, [T.StructField(name, T.DoubleType())], ["text"])
