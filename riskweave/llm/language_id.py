"""Language identification by character language models.

For each language an interpolated Kneser-Ney model of order ``ORDER`` is fitted to the letters
of words in lower case, with a blank before and after each word; contexts do not reach over a
word. All models together are kept as sorted arrays of n-gram hashes, with one row of
discounted probabilities or back-off weights a hash and one column a language. A text gets the
language of the lowest cross-entropy a character. It is accepted if that cross-entropy is at
most the ``ACCEPT`` quantile of held-back training texts of that language.

Defined cases: a null text and a text without letters are ``und`` with score 0.0 and not
accepted; characters outside the training texts cost the uniform share; repeated rows agree;
ties go to the first language by name; without training rows every text is ``und``; every language
with a training row is learned, also where rows share an id or a text or have none; an empty table gives
an empty one; texts are scored whole, word by word, and words beyond ``LONGEST`` letters in pieces.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import append_columns, mix

ORDER = 4
#: Training texts of each language, at most about; one in five is held back to calibrate.
SAMPLE = 400
HELD_BACK = 5
ACCEPT = 0.995
#: Characters that count as evidence in the score.
EVIDENCE = 64
#: Characters of which an unseen one may be any.
ALPHABET = 4_096
#: Words whose scores a worker remembers.
MEMORY = 200_000
LONGEST = 48
UNDETERMINED = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters(word: str) -> str:
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_hash(grams: list[str]) -> np.ndarray:
    """Hashes of strings of one length."""
    if not grams:
        return np.empty(0, np.uint64)
    table = codes("".join(grams)).reshape(len(grams), -1)
    out = np.zeros(len(grams), np.uint64)
    for column in table.T:
        out = mix(out * _STEP + column)
    return out


@dataclass
class LanguageModels:
    languages: list[str] = field(default_factory=list)
    #: For each order: sorted hashes of n-grams and their discounted probabilities by language,
    #: and the same of contexts and back-off weights.
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    limits: np.ndarray = field(default_factory=lambda: np.empty(0))

    def words(self, words: list[str]) -> np.ndarray:
        """For each word of letters: log-probabilities by language, and its characters."""
        text = codes("".join(f" {w} " for w in words))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(len(text)) - np.repeat(starts, sizes)
        p = np.full((len(text), len(self.languages)), 1.0 / ALPHABET)
        for order, (keys, alpha, contexts, gamma) in enumerate(self.grams, 1):
            reach = np.flatnonzero(place >= max(order - 1, 1))
            whole = np.zeros(len(reach), np.uint64)
            context = whole
            for back in range(order - 1, -1, -1):
                context = whole
                whole = mix(whole * _STEP + text[reach - back])
            at = np.searchsorted(contexts, context)
            at[at == len(contexts)] = 0
            known = contexts[at] == context
            reach, whole, at = reach[known], whole[known], at[known]
            p[reach] *= gamma[at]
            at = np.searchsorted(keys, whole)
            at[at == len(keys)] = 0
            seen = keys[at] == whole
            p[reach[seen]] += alpha[at[seen]]
        logs = np.where((place > 0)[:, None], np.log(p), 0.0)
        return np.column_stack([np.add.reduceat(logs, starts, axis=0), sizes - 1.0])

    def scorer(self):
        """A function from texts to an array: log-probabilities by language, and characters."""
        wide = len(self.languages) + 1
        place: dict[str, int] = {}
        rows = np.zeros((1, wide))

        def score(texts: list[str | None]) -> np.ndarray:
            nonlocal rows, place
            if len(place) >= MEMORY:
                place, rows = {}, np.zeros((1, wide))
            split = [(t or "").split() for t in texts]
            fresh = {w for words in split for w in words if w not in place}
            if fresh:
                fresh = sorted(fresh)
                bare = [letters(w) for w in fresh]
                full = [w for w in dict.fromkeys(bare) if w]
                made = self.words(full) if full else np.zeros((0, wide))
                at = dict(zip(full, range(len(rows), len(rows) + len(full)), strict=True))
                rows = np.concatenate([rows, made])
                place.update((w, at.get(b, 0)) for w, b in zip(fresh, bare, strict=True))
            out = np.array([rows[[place[w] for w in words]].sum(axis=0) if words else np.zeros(wide) for words in split])
            for w in [w for w in fresh if len(w) > LONGEST]:
                place.pop(w, None)
            return out.reshape(len(texts), wide)

        return score

    def decide(self, sums: np.ndarray):
        """(best language or -1, score, cross-entropy, accepted) of each row of sums."""
        n = sums[:, -1]
        if not self.languages:
            zero = np.zeros(len(sums))
            return np.full(len(sums), -1), zero, zero, zero > 0
        entropy = -sums[:, :-1] / np.maximum(n, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        share = 1 / np.exp(-(entropy - low[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(axis=1)
        some = n > 0
        return np.where(some, best, -1), np.where(some, share, 0.0), low, some & (low <= self.limits[best])


def kneser_ney(counts: dict[str, dict[str, int]]) -> LanguageModels:
    """Models from the counts by language of the longest n-gram that ends at each character."""
    languages = sorted(counts)
    if not languages:
        return LanguageModels()
    tables = [defaultdict(lambda: np.zeros(len(languages))) for _ in range(ORDER)]
    weights = [defaultdict(lambda: np.ones(len(languages))) for _ in range(ORDER)]
    for column, language in enumerate(languages):
        order_counts: list[Counter] = [Counter() for _ in range(ORDER + 1)]
        for gram, n in counts[language].items():
            order_counts[len(gram)][gram] += n
        # Shorter n-grams count the different characters before them; at a word's begin, where
        # there is none, they keep their own counts.
        for k in range(ORDER, 1, -1):
            for gram in order_counts[k]:
                if k > 2 or gram[1:] != " " or gram[0] != " ":
                    order_counts[k - 1][gram[1:]] += 1
        for k in range(1, ORDER + 1):
            table = order_counts[k]
            ones = sum(1 for n in table.values() if n == 1)
            twos = sum(1 for n in table.values() if n == 2)
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.1))
            total, kinds = Counter(), Counter()
            for gram, n in table.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            for gram, n in table.items():
                tables[k - 1][gram][column] = (n - discount) / total[gram[:-1]]
            for context, n in total.items():
                weights[k - 1][context][column] = discount * kinds[context] / n
    grams = []
    for table, weight in zip(tables, weights, strict=True):
        arrays = []
        for part in (table, weight):
            keys = gram_hash(list(part)) if "" not in part else np.zeros(1, np.uint64)
            order = np.argsort(keys)
            arrays += [keys[order], np.array(list(part.values())).reshape(len(part), -1)[order]]
        grams.append(tuple(arrays))
    return LanguageModels(languages, grams, np.full(len(languages), np.inf))


def _sample(docs: DataFrame, keep: Column) -> DataFrame:
    """(lang, text, part): about ``SAMPLE`` rows of each language, chosen by a hash of id and text.

    Rows that share an id, or have none, are chosen by their texts; equal rows go together. The row of
    the least hash is always there, and learned from, so no language is left without a text.
    """
    rows = docs.filter(keep & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    wide = 1 << 30
    rows = rows.withColumn("dealt", F.xxhash64("doc_id", "text", F.lit("language")))
    turn = F.pmod("dealt", F.lit(wide))
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(turn, "dealt")).alias("least"))
    shares = shares.select("lang", F.least(F.lit(1.0), SAMPLE / F.col("n")).alias("share"), "least.dealt")
    shares = shares.withColumnRenamed("dealt", "first")
    sure = F.col("dealt") == F.col("first")
    part = F.when(sure, 1).otherwise(F.pmod(F.shiftright("dealt", 32), F.lit(HELD_BACK)))
    return (
        rows.join(F.broadcast(shares), "lang")
        .filter((turn < F.col("share") * wide) | sure)
        .select("lang", "text", part.alias("part"))
    )


def _gram_counts(sample: DataFrame) -> DataFrame:
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter((text or "").split()).items():
                    if w := letters(word):
                        s = f" {w} "
                        for i in range(1, len(s)):
                            counts[language, s[max(0, i - ORDER + 1) : i + 1]] += n
        yield pa.RecordBatch.from_pydict(
            {"lang": [k[0] for k in counts], "gram": [k[1] for k in counts], "n": list(counts.values())},
            schema=pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]),
        )

    return (
        sample.select("lang", "text")
        .mapInArrow(run, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def fit(docs: DataFrame, keep: Column) -> LanguageModels:
    """Models of the languages of the rows that ``keep`` allows, from a bounded sample of each."""
    sample = _sample(docs, keep)
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in _gram_counts(sample.filter("part != 0")).toArrow().to_pylist():
        counts[r["lang"]][r["gram"]] = r["n"]
    models = kneser_ney(counts)
    if not models.languages:
        return models
    held = predict(sample.filter("part = 0"), models)
    quantiles = (
        held.filter("lang = lang_pred")
        .groupBy("lang")
        .agg(F.percentile("cross_entropy", ACCEPT).alias("limit"))
        .collect()
    )
    limits = {r["lang"]: r["limit"] for r in quantiles}
    models.limits = np.array([limits.get(x, np.inf) for x in models.languages])
    return models


def predict(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy and accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        m = shared.value
        of = m.scorer()
        names = [*m.languages, UNDETERMINED]

        def fn(texts):
            best, share, low, accepted = m.decide(of(texts.to_pylist()))
            return (
                pa.array([names[b] for b in best.tolist()], pa.string()),
                pa.array(share), pa.array(low), pa.array(accepted),
            )

        return fn

    new = [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()), T.StructField("accepted", T.BooleanType()),
    ]
    return append_columns(docs, make, new, ["text"])
