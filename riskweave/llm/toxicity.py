"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with probability
sigmoid(bias + weights of its distinct features); a document is toxic unless all its sentences
are clean (noisy-or). Only document labels are used to train; the fitted sentence model then
says which sentences offend.

Features of a word, without punctuation and in lower case: the word and its first 3, 4 and 5
letters, each hashed to one of 2**20 slots. A slot is a feature if its share of toxic
documents differs clearly from its share of the others in the training sample.

Defined cases: a null text is empty; an empty text has no sentence and score 0.0 (below that
of any other text); repeated rows score alike; rows without id are scored; with no labelled
row, or rows of one label only, every score is 0.0 and nothing is rejected; an empty table gives an empty
one; very long texts are scored whole, sentence by sentence.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import append_columns, labelled_sample

#: Labelled documents in the training sample, at most (both labels together).
SAMPLE = 12_000
SLOTS = 1 << 20
#: Features kept, at most, and the least z-score of the difference of the two shares.
FEATURES = 8_192
LEAST_Z = 5.0
REJECT_AT = 0.7
#: A sentence at least this probable is reported as offending.
OFFENDS_AT = 0.5
#: Words whose weight a worker remembers before it starts anew.
MEMORY = 200_000

SENTENCE = re.compile(r"[^.!?\n]+")
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"


def slots(word: str) -> set[int]:
    core = word.strip(EDGES).lower()
    if not core:
        return set()
    found = {zlib.crc32(f"w {core}".encode()) % SLOTS}
    for n in (3, 4, 5):
        if len(core) > n:
            found.add(zlib.crc32(f"{n} {core[:n]}".encode()) % SLOTS)
    return found


@dataclass
class ToxicityModel:
    """Weights by slot, the bias, and the two thresholds."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -math.inf

    def scorer(self):
        """A function from a text to (score, [(begin, end, probability) of offending sentences])."""
        known, memory = self.weights, {}

        def features_of(word):
            if len(memory) >= MEMORY:
                memory.clear()
            memory[word] = hit = tuple((s, known[s]) for s in slots(word) if s in known)
            return hit

        def score(text: str | None):
            clean, offending = 0.0, []
            empty = 0
            if not text or not known:
                return 0.0, offending
            for m in SENTENCE.finditer(text):
                hits: dict[int, float] = {}
                words = set(m[0].split())
                if not words:
                    continue
                for w in words:
                    hit = memory.get(w)
                    if hit is None:
                        hit = features_of(w)
                    if hit:
                        hits.update(hit)
                if not hits:
                    empty += 1
                    continue
                z = self.bias + sum(hits.values())
                clean -= max(z, 0.0) + math.log1p(math.exp(-abs(z)))
                p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
                if p >= OFFENDS_AT:
                    offending.append((m.start(), m.end(), p))
            clean -= empty * math.log1p(math.exp(self.bias))
            return -math.expm1(clean), offending

        return score


def _slot_counts(sample: DataFrame) -> DataFrame:
    """(slot, bad, good): documents of either label that have the slot."""

    def run(batches):
        counts = np.zeros((2, SLOTS), np.int64)
        memory: dict[str, set[int]] = {}
        for batch in batches:
            for text, y in zip(
                batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True
            ):
                seen: set[int] = set()
                for w in set((text or "").split()):
                    if w not in memory:
                        if len(memory) >= MEMORY:
                            memory.clear()
                        memory[w] = slots(w)
                    seen |= memory[w]
                if seen:
                    counts[int(bool(y)), np.fromiter(seen, np.int64, len(seen))] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(counts[1, at]), pa.array(counts[0, at])],
            names=["slot", "bad", "good"],
        )

    parts = sample.select("text", "y").mapInArrow(run, "slot long, bad long, good long")
    return parts.groupBy("slot").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _bags(sample: DataFrame, chosen: list[int]) -> DataFrame:
    """(y, empty, parts): sentences without a feature, and the features of the others."""
    known = sample.sparkSession.sparkContext.broadcast(frozenset(chosen))

    def run(batches):
        keep = known.value
        for batch in batches:
            out = []
            for text, y in zip(
                batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True
            ):
                empty, parts = 0, []
                for s in SENTENCE.findall(text or ""):
                    if words := set(s.split()):
                        if hit := {x for w in words for x in slots(w) if x in keep}:
                            parts.append(sorted(hit))
                        else:
                            empty += 1
                out.append((int(bool(y)), empty, parts))
            y, empty, parts = map(list, zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(y, pa.int32()),
                    pa.array(empty, pa.int64()),
                    pa.array(parts, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["y", "empty", "parts"],
            )

    return sample.select("text", "y").mapInArrow(
        run, "y int, empty long, parts array<array<long>>"
    )


def noisy_or_fit(
    y: np.ndarray,
    empty: np.ndarray,
    doc_of: np.ndarray,
    rows: np.ndarray,
    cols: np.ndarray,
    n_features: int,
    steps: int = 400,
    l2: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels under noisy-or.

    ``doc_of``: the document of each sentence; ``rows``/``cols``: sentence and feature of each
    hit; ``empty``: sentences of each document without a hit, which only have the bias.
    """
    w, b = np.full(n_features, 0.5), -4.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, steps + 1):
        z = b + np.bincount(rows, w[cols], len(doc_of))
        loss = np.logaddexp(0, z)
        clean = np.bincount(doc_of, loss, len(y)) + empty * np.logaddexp(0, b)
        # d(-log likelihood)/dz of a sentence: sigmoid for clean documents, and
        # -sigmoid * P(clean) / P(toxic) for toxic ones.
        factor = share * np.where(y == 1, -1 / np.expm1(np.maximum(clean, 1e-9)), 1.0)
        dz = factor[doc_of] / (1 + np.exp(-z))
        gb = dz.sum() + (factor * empty).sum() / (1 + math.exp(-b))
        g = np.append(np.bincount(cols, dz[rows], n_features) + l2 * w, gb)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> ToxicityModel:
    """Train on a bounded sample of the labelled documents (of the labels that ``keep`` allows)."""
    sample = labelled_sample(docs, labels, "toxic", keep, SAMPLE)
    totals = {int(bool(r["y"])): r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return ToxicityModel()
    p, q = F.col("bad") / bad, F.col("good") / good
    mean = (F.col("bad") + F.col("good")) / (bad + good)
    z = (p - q) / F.sqrt(mean * (1 - mean) * (1 / bad + 1 / good) + F.lit(1e-12))
    picked = (
        _slot_counts(sample)
        .filter((F.col("bad") + F.col("good") >= 4) & (F.abs(z) >= LEAST_Z))
        .orderBy(F.abs(z).desc(), "slot")
        .limit(FEATURES)
        .select("slot")
    )
    chosen = sorted(r["slot"] for r in picked.collect())
    if not chosen:
        return ToxicityModel()
    bags = _bags(sample, chosen).toArrow()
    parts = bags["parts"].combine_chunks()
    sentences = parts.flatten()

    def owners(lists):
        """The place of the list that each element is in."""
        return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))

    w, b = noisy_or_fit(
        bags["y"].to_numpy(),
        bags["empty"].to_numpy(),
        owners(parts),
        owners(sentences),
        np.searchsorted(chosen, sentences.flatten().to_numpy()),
        len(chosen),
    )
    return ToxicityModel(dict(zip(chosen, w.tolist(), strict=True)), float(b))


def score(docs: DataFrame, model: ToxicityModel, prefix: str = "") -> DataFrame:
    """``docs`` with score and offending (begin, end, probability of the sentences that offend)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spot = T.StructType(
        [
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )
    kind = pa.list_(
        pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
    )

    def make():
        of = shared.value.scorer()

        def fn(texts):
            scores, spots = [], []
            for t in texts:
                s, found = of(t.as_py())
                scores.append(s)
                spots.append(
                    [{"begin": x, "end": y, "probability": p} for x, y, p in found]
                )
            return pa.array(scores, pa.float64()), pa.array(spots, kind)

        return fn

    fields = [
        T.StructField(f"{prefix}score", T.DoubleType()),
        T.StructField(f"{prefix}offending", T.ArrayType(spot)),
    ]
    return append_columns(docs, make, fields, ["text"])
