"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Items are cut into parts of at most ``SPAN`` words and indexed; training texts are cut into
passages of two spans that overlap by one, so each part that occurs in a text lies whole in
some passage. Every passage is a query (its distinct words); scores are BM25 divided by what
the part scores against itself, so 1 means that all words of the part are there.

The index keeps parts in blocks, and for each block and word the largest impact (block
maximum) next to the impacts of the single parts. A block is looked at only if the passage
holds one of its essential words - words without which no part of the block can reach the
threshold, as the rest of its impacts is too small (the WAND pivot) - and its parts are
scored only if the block maxima of the words at hand reach the threshold.

A retrieved part is verified in the passage and the span on either side: of the word shingles
of its question (all sentences but the last) and of its answer (the last one) at least
``OVERLAP`` must occur, each.

Words are runs of letters, digits and non-ASCII characters, A-Z as a-z, compared by a 64-bit
hash. The index is built from a bounded number of item bytes at a time (``INDEX_BYTES``);
larger benchmarks are searched shard by shard, with the document frequencies and the mean length of
the whole benchmark, so that scores do not depend on the shards.

Items with fewer than ``LEAST`` words are too short for shares of shingles: a text holds one if its
words stand there in a row, and its score and overlaps are 1.

Defined cases: null and empty texts hold nothing; items without words are in no text; copies of an
item are all reported, items without item_id with a null one;
repeated rows are reported alike, rows without doc_id with a null id; an empty benchmark or
an empty table gives no rows; texts are searched whole, passage by passage.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import PUNCT, append_columns, chunk_words, word_hashes, word_runs
from riskweave.session import stored

K1, B = 1.2, 0.75
#: Least share of a part's own score, and least share of its question's and answer's shingles.
THRESHOLD = 0.7
OVERLAP = 0.8
#: What the words without posting lists may add to a score, at most.
REST = 0.4
SHINGLE = 5
SPAN = 64
LEAST = 5
BLOCK = 8
#: Item text in one broadcast index, at most.
INDEX_BYTES = 16 << 20


def words_of(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(raw, PUNCT)[0]


def share(wanted: np.ndarray, near: np.ndarray) -> float:
    """Share of the runs of five words of ``wanted`` (of all its words, if fewer) in ``near``.

    A half without words is there.
    """
    n = min(SHINGLE, len(wanted))
    return float(np.isin(word_runs(wanted, n), word_runs(near, n)).mean()) if n else 1.0


def word_lengths(text: str) -> dict[int, int]:
    """word -> about its length in bytes (with what separates it from the next)."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words, starts = word_hashes(raw, PUNCT)
    return dict(zip(words.tolist(), np.diff(np.append(starts, len(raw))).tolist(), strict=True))


def halves(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Words of question and answer: the last sentence answers what stands before it.

    An item of one sentence is split in the middle.
    """
    parts = [w for s in re.split(r"(?<=[.!?])\s+|\n+", text) if len(w := words_of(s))]
    if len(parts) > 1:
        return np.concatenate(parts[:-1]), parts[-1]
    words = parts[0] if parts else words_of(None)
    return words[: len(words) // 2], words[len(words) // 2 :]


def parts_of(text: str | None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, words of the question, of the answer) of the parts of an item; none of a short one."""
    question, answer = halves(text or "")
    words = np.concatenate([question, answer])
    if len(words) < LEAST:
        return []
    # Parts of equal length, so that no part is a short rest.
    n = -(-len(words) // SPAN)
    cuts = [(len(words) * i // n, len(words) * (i + 1) // n) for i in range(n)]
    return [(words[a:b], words[a : min(b, len(question))], words[max(a, len(question)) : b]) for a, b in cuts]


@dataclass
class Statistics:
    """Parts of a benchmark, their words, and in how many parts a word is."""

    parts: int
    words: int
    df: dict[int, int]


@dataclass
class Part:
    item: int | None
    words: np.ndarray
    impacts: np.ndarray
    question: np.ndarray
    answer: np.ndarray


class Index:
    """Blocks of parts with their words, block maxima, and essential words."""

    def __init__(self, items: list[tuple[int | None, str]], statistics: Statistics | None = None):
        """``statistics`` are those of the whole benchmark; by default of ``items``."""
        cut = [(item, *part) for item, text in items for part in parts_of(text)]
        if statistics is None:
            df: dict[int, int] = {}
            for _, words, _, _ in cut:
                for w in np.unique(words).tolist():
                    df[w] = df.get(w, 0) + 1
            statistics = Statistics(len(cut), sum(len(c[1]) for c in cut), df)
        many, df, mean = statistics.parts, statistics.df, statistics.words / max(statistics.parts, 1)
        # Short items by their number of words: the hash of all of them, and the item.
        self.short: dict[int, tuple[np.ndarray, list]] = {}
        brief = [(item, w) for item, text in items if 0 < len(w := np.concatenate(halves(text or ""))) < LEAST]
        for n in {len(w) for _, w in brief}:
            found = sorted((int(word_runs(w, n)[0]), (item is None, item or 0), item) for item, w in brief if len(w) == n)
            self.short[n] = np.array([f[0] for f in found], np.uint64), [f[2] for f in found]
        self.parts = []
        for item, words, q, a in cut:
            terms, tf = np.unique(words, return_counts=True)
            idf = np.array([math.log(1 + (many - df[w] + 0.5) / (df[w] + 0.5)) for w in terms.tolist()])
            gain = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            self.parts.append(Part(item, terms, gain / gain.sum(), q, a))
        # Parts that share words stand together, which keeps block maxima tight.
        self.parts.sort(key=lambda p: (p.words[np.argmax(p.impacts)], p.item is None, p.item or 0))
        rank = {}
        for _, text in items:
            rank.update(word_lengths(text))
        self.blocks, postings = [], []
        self.rest = []
        for at, first in enumerate(range(0, len(self.parts), BLOCK)):
            parts = self.parts[first : first + BLOCK]
            terms = np.unique(np.concatenate([p.words for p in parts]))
            table = np.zeros((len(parts), len(terms)))
            essential = np.zeros(len(terms), bool)
            for row, p in zip(table, parts, strict=True):
                places = np.searchsorted(terms, p.words)
                row[places] = p.impacts
                order = np.lexsort((p.words, [-rank[w] for w in p.words.tolist()]))
                rest = 1 - np.cumsum(p.impacts[order])
                essential[places[order[: int(np.argmax(rest <= REST)) + 1]]] = True
            maxima = table.max(axis=0)
            postings += [(w, at, m) for w, m in zip(terms[essential].tolist(), maxima[essential], strict=True)]
            self.rest.append(table[:, ~essential].sum(axis=1).max())
            self.blocks.append((terms, maxima, table, parts))
        postings.sort()
        words = np.array([w for w, _, _ in postings], np.uint64)
        self.essential, self.first = np.unique(words, return_index=True)
        self.count = np.diff(np.append(self.first, len(words)))
        self.block = np.array([b for _, b, _ in postings], np.int64)
        self.impact = np.array([m for _, _, m in postings])
        self.rest = np.array(self.rest)

    def candidates(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, passage, block) triples whose bound reaches the threshold.

        ``at``: the first word of each text in ``words``, and the end.
        """
        none = np.empty(0, np.int64)
        if not len(self.essential) or not len(words):
            return none, none, none
        place = np.searchsorted(self.essential, words)
        place[place == len(self.essential)] = 0
        hits = np.flatnonzero(self.essential[place] == words)
        place = place[hits]
        text = np.searchsorted(at, hits, "right") - 1
        # Texts have their passages one after another; a word lies in one or two of them.
        base = np.concatenate(([0], np.cumsum((np.diff(at) + SPAN - 1) // SPAN)))
        local = (hits - at[text]) // SPAN
        late = local > 0
        passage = np.concatenate([base[text] + local, (base[text] + local - 1)[late]])
        place = np.concatenate([place, place[late]])
        if not len(place):
            return none, none, none
        # A word counts once a passage, however often it stands there.
        once = np.unique(passage * len(self.essential) + place)
        passage, place = once // len(self.essential), once % len(self.essential)
        count = self.count[place]
        of = np.repeat(np.arange(len(place)), count)
        posting = self.first[place][of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        pair, inverse = np.unique(passage[of] * len(self.blocks) + self.block[posting], return_inverse=True)
        bound = np.bincount(inverse, self.impact[posting])
        passage, block = pair // len(self.blocks), pair % len(self.blocks)
        keep = bound + self.rest[block] >= THRESHOLD - 1e-9
        passage, block = passage[keep], block[keep]
        text = np.searchsorted(base, passage, "right") - 1
        return text, passage - base[text], block

    def search(self, words: np.ndarray, at: np.ndarray) -> list[dict[int, tuple[float, float, float]]]:
        """For each text: item -> (score, question overlap, answer overlap) of what it holds."""
        found: list[dict] = [{} for _ in range(len(at) - 1)]
        for t, passage, b in zip(*(x.tolist() for x in self.candidates(words, at)), strict=True):
            own = words[at[t] : at[t + 1]]
            a = passage * SPAN
            terms, maxima, table, parts = self.blocks[b]
            at_hand = np.isin(terms, own[a : a + 2 * SPAN])
            if maxima[at_hand].sum() < THRESHOLD:
                continue
            scores = table[:, at_hand].sum(axis=1)
            near = own[max(0, a - SPAN) : a + 3 * SPAN]
            for i in np.flatnonzero(scores >= THRESHOLD).tolist():
                q, s = share(parts[i].question, near), share(parts[i].answer, near)
                if q >= OVERLAP and s >= OVERLAP:
                    item = parts[i].item
                    old = found[t].get(item, (0.0, 0.0, 0.0))
                    found[t][item] = max(old, (round(float(scores[i]), 9), q, s))
        for n, (keys, items) in self.short.items():
            runs = word_runs(words, n)
            first = np.searchsorted(keys, runs)
            for place in np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == runs).tolist():
                t = int(np.searchsorted(at, place, "right")) - 1
                if place + n <= at[t + 1]:  # not over the end of a text
                    i = first[place]
                    while i < len(keys) and keys[i] == runs[place]:
                        found[t][items[i]] = (1.0, 1.0, 1.0)
                        i += 1
        return found


def _word_counts(items: DataFrame) -> DataFrame:
    """(word, df, size): in how many parts each word is; the row without a word counts parts and words."""

    def run(batches):
        for batch in batches:
            word, size = [], []
            for text in batch.column(0).to_pylist():
                for words, _, _ in parts_of(text):
                    own = np.unique(words).view(np.int64).tolist()
                    word += [None, *own]
                    size += [len(words), *[0] * len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(size, pa.int64())], names=["word", "size"])

    parts = items.select("text").mapInArrow(run, "word long, size long")
    return parts.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.sum("size").alias("size"))


def _shards(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over hash shards of the items, each of bounded size."""
    items = benchmark.select("item_id", "text").dropna(subset=["text"]).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(size // (INDEX_BYTES // 2)) + 1
    counts = stored(_word_counts(items), "item-words") if n > 1 else None
    for shard in range(n):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == shard)
        rows = sorted(((r["item_id"], r["text"]) for r in mine.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        statistics = None
        if counts is not None:
            whole = counts.filter("word is null").first()
            own = counts.join(_word_counts(mine).select("word"), "word").toArrow()
            df = dict(zip(own["word"].to_numpy().view(np.uint64).tolist(), own["df"].to_pylist(), strict=True))
            statistics = Statistics(whole["df"] if whole else 0, whole["size"] if whole else 0, df)
        yield Index(rows, statistics)


def matches(docs: DataFrame, benchmark: DataFrame, name: str = "found") -> DataFrame:
    """``docs`` with the items each text holds: array of (item_id, score, question, answer)."""
    names = ("item_id", "score", "question", "answer")
    hit = T.StructType([T.StructField(n, T.DoubleType() if n != names[0] else T.LongType()) for n in names])
    kind = pa.list_(pa.struct([(n, pa.float64() if n != names[0] else pa.int64()) for n in names]))
    out, steps = docs, []
    for at, index in enumerate(_shards(benchmark)):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            index = shared.value

            def fn(texts):
                rows = []
                for _, _, words, at in chunk_words(texts, PUNCT):
                    for hits in index.search(words, at):
                        rows.append([dict(zip(names, (k, *v), strict=True)) for k, v in sorted(hits.items(), key=lambda h: (h[0] is None, h[0] or 0))])
                return (pa.array(rows, kind),)

            return fn

        steps.append(f"{name}_{at}")
        out = append_columns(out, make, [T.StructField(steps[-1], T.ArrayType(hit))], ["text"])
    return out.withColumn(name, F.concat(*steps)).drop(*steps)
