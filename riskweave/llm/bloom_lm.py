"""Language-model scores from a log-frequency Bloom filter.

Training counts word unigrams and bigrams over all training texts (words between ASCII blanks,
A-Z as a-z, and one end after each text). The filter holds each n-gram once for every level
1, 2, ..., q of its quantised count q = 1 + floor(log_1.5 count); a count is read back by probing
levels until one is missing. With ``least_pairs`` 1 every bigram is stored; with 2, the default, those
seen once are not and count as unseen, which keeps the filter small. The probability of a word is

    p(w | v) = (c(v, w) + MU * p(w)) / (max(c(v), c(v, w)) + MU),   p(w) = (c(w) + 1) / (N + V + 1)

with c read from the filter, N training tokens and V distinct ones (the word before the first
is the start, as frequent as the end).

Counting gathers n-grams in tasks and passes them on as sorted blocks, a row for each part of the
hash space: gaps between hashes in as few bytes as they need, and counts. Each part is merged by
one task and stays a row. The number of parts follows the bytes of the texts, so that a part fits
a task at every size.

The filter is split into blocks by the first bits of an n-gram's hash, so that one task builds
some blocks and a batch of sorted probes walks through them. Its size follows the number of
insertions, so every n-gram is held and the error rate stays the same. Up to ``FILTER_BITS`` it
is broadcast. A larger one is cut into shards of ``SHARD_BITS``, which are never in one place:
texts are shuffled once into units of about ``UNIT_BYTES``, the distinct n-grams of a unit go, packed
like the counts, to the tasks that build their shards, the levels come back to the unit, a byte for
each, and the unit is scored. Both ways read the same bits, so they give the same scores.

``base_score`` is exact. Beside a broadcast filter, words that occur often are a bounded broadcast
table (the ``FREQUENT`` most frequent, cut at a level of counts), and the others are joined by a shuffle;
shards send the counts of words along with their levels. Words are
compared by 63 bits of a hash (two of a billion different words meet with a chance of
about one in twenty), bigrams by 48: of a billion of them, some thousand share the count of another,
far fewer than the filter confuses.

Defined cases: a null text is empty; an empty text is one end; repeated rows score and count each
time; with nothing to learn from, N and V are 0 and all scores are 0; an empty table gives none. Texts are
read whole; one longer than a unit is a unit of its own.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import WHITE, append_columns, chunk_words, mix
from riskweave.session import stored

#: Base of the levels of counts.
GROWTH = 1.5
LEVELS = 96
#: Bits of a broadcast filter at most (4 MB: any larger corpus takes the way that grows in proportion), of a shard of a larger one (2 MB), of one block, and
#: for each insertion at least.
FILTER_BITS = 1 << 25
SHARD_BITS = 1 << 24
BLOCK_BITS = 1 << 18
INSERT_BITS = 10
PROBES = 2
#: Words with an exact broadcast count, at most.
FREQUENT = 1 << 19
#: N-grams a task gathers before it passes their counts on; text bytes of a part of the hash space, about;
#: text bytes of a unit, about.
GATHER = 1 << 23
PART_BYTES = 8 << 20
UNIT_BYTES = 16 << 20
#: Weight of the word's own probability against what follows the word before.
MU = 300.0

END = np.uint64(0xE0D0F7E27A11B0A2)
START = np.uint64(0x57A27C0DE5EED5A1)
_ODD = np.uint64(1)
_PAIR_SHIFT = np.uint64(16)

_bounds = np.ceil(GROWTH ** np.arange(LEVELS)).astype(np.float64)
#: The count a level stands for: the middle of the counts it holds; level 0 is none.
_MEANING = np.concatenate(([0.0], (_bounds + np.maximum(np.append(_bounds[1:], _bounds[-1]) - 1, _bounds)) / 2))


def levels(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_bounds, counts, "right")


def ngrams(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, bigram keys, first token of each text); even keys are words, odd bigrams."""
    texts = len(at) - 1
    tokens = np.empty(len(words) + texts, np.uint64)
    ends = at[1:] + np.arange(texts)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[ends], tokens[inner] = END, words
    first = np.concatenate(([0], ends[:-1] + 1)) if texts else np.empty(0, np.int64)
    before = np.roll(tokens, 1)
    before[first] = START
    pairs = mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens) >> _PAIR_SHIFT << _PAIR_SHIFT
    return tokens & ~_ODD, pairs | _ODD, first


def pack(keys: np.ndarray, shift: np.uint64) -> bytes:
    """Sorted different keys, without their last ``shift`` bits: the first, and the gaps in equal bytes."""
    if not len(keys):
        return b""
    short = keys >> shift
    gaps = np.diff(short)
    width = max(1, -(-int(gaps.max(initial=0)).bit_length() // 8))
    raw = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return short[:1].astype("<u8").tobytes() + bytes([width]) + raw.tobytes()


def unpack(raw: bytes, shift: np.uint64) -> np.ndarray:
    if not raw:
        return np.empty(0, np.uint64)
    width = raw[8]
    short = np.zeros(((len(raw) - 9) // width + 1, 8), np.uint8)
    short[1:, :width] = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    short[0] = np.frombuffer(raw, np.uint8, 8)
    return np.cumsum(short.view("<u8").reshape(-1), dtype=np.uint64) << shift


def pack_counts(n: np.ndarray) -> bytes:
    """A byte a count; those of 255 or more follow in full."""
    large = n >= 255
    return np.where(large, 255, n).astype(np.uint8).tobytes() + n[large].astype("<i8").tobytes()


def unpack_counts(raw: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(raw, "<i8", offset=size)
    return n


def split_kinds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the bigrams among keys."""
    odd = (keys & _ODD).astype(bool)
    return keys[~odd], keys[odd]


def by_part(keys: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """(part, place) of sorted keys, for parts that have some."""
    names, at = np.unique(Filter.block_of(keys, parts), return_index=True)
    return [(int(p), slice(a, b)) for p, a, b in zip(names, at, [*at[1:], len(keys)], strict=True)]


PACKED = "words binary, word_n binary, pairs binary, pair_n binary"


def decode(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, counts, bigrams, counts) of a packed row."""
    words, pairs = unpack(row["words"], _ODD), unpack(row["pairs"], _PAIR_SHIFT) | _ODD
    return words, unpack_counts(row["word_n"], len(words)), pairs, unpack_counts(row["pair_n"], len(pairs))


def counts(texts: DataFrame, least_pairs: int = 2) -> DataFrame:
    """The n-grams of the column text, all words and the bigrams of ``least_pairs`` or more: a packed row for each part.

    Further columns: ``tokens``, and by level of counts the number of words and of bigrams and the
    least count of a word.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 << max(0, (size // PART_BYTES).bit_length())

    def run(batches):
        held, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            odd = (keys & _ODD).astype(bool)
            rows: dict[int, dict] = {}
            for name, own, shift in (("word", ~odd, _ODD), ("pair", odd, _PAIR_SHIFT)):
                k, c = keys[own], n[own]
                for part, at in by_part(k, parts):
                    row = rows.setdefault(part, dict(part=part, words=b"", word_n=b"", pairs=b"", pair_n=b""))
                    row[f"{name}s"], row[f"{name}_n"] = pack(k[at], shift), pack_counts(c[at])
            rows = list(rows.values())
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[i : i + 256])

        for batch in batches:
            for _, _, words, at in chunk_words(batch.column(0), WHITE):
                held += ngrams(words, at)[:2]
                size += 2 * (len(words) + len(at) - 1)
                if size >= GATHER:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def merge(rows):
        found = [decode(r) for r in rows.to_pylist()]
        out = {"part": rows["part"][0].as_py()}
        for name, i, least, shift in (("word", 0, 1, _ODD), ("pair", 2, least_pairs, _PAIR_SHIFT)):
            keys, back = np.unique(np.concatenate([f[i] for f in found]), return_inverse=True)
            n = np.bincount(back, np.concatenate([f[i + 1] for f in found]), len(keys)).astype(np.int64)
            if name == "word":
                out["tokens"] = int(n.sum())
            keys, n = keys[n >= least], n[n >= least]
            q = levels(n)
            out[f"{name}s"], out[f"{name}_n"] = pack(keys, shift), pack_counts(n)
            out[f"{name}_levels"] = np.bincount(q, minlength=LEVELS + 1)
            if name == "word":
                low = np.full(LEVELS + 1, np.iinfo(np.int64).max)
                np.minimum.at(low, q, n)
                out["least"] = low
        return pa.table({c: pa.array([out[c]], k) for c, k in kinds.items()})

    long, longs = pa.int64(), pa.list_(pa.int64())
    kinds = dict(
        part=long, words=pa.binary(), word_n=pa.binary(), pairs=pa.binary(), pair_n=pa.binary(), tokens=long,
        word_levels=longs, pair_levels=longs, least=longs,
    )
    packed = texts.select("text").mapInArrow(run, f"part long, {PACKED}")
    lists = "word_levels array<long>, pair_levels array<long>, least array<long>"
    merged = packed.groupBy("part").applyInArrow(merge, f"part long, {PACKED}, tokens long, {lists}")
    return merged.withColumn("parts", F.lit(parts))


def word_counts(grams: DataFrame, low: int, high: int) -> DataFrame:
    """(key, n) of the words with ``low`` <= n < ``high``."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["words"], _ODD)
                n = unpack_counts(row["word_n"], len(keys))
                some = (n >= low) & (n < high)
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(n[some])], names=["key", "n"])

    return grams.select("words", "word_n").mapInArrow(run, "key long, n long")


class Filter:
    """The log-frequency Bloom filter: ``bits`` in ``blocks`` (a power of two) of equal size."""

    def __init__(self, blocks: int, bits: np.ndarray, first: int = 0):
        """``bits`` may be those of some of the blocks, from the block ``first`` on."""
        self.blocks, self.bits, self.first = blocks, bits, first

    @staticmethod
    def places(keys: np.ndarray, level) -> list[np.ndarray]:
        """Bits of one level inside the key's block."""
        seed = mix(keys + np.asarray(level, np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return [(seed >> np.uint64(20 * i)) & np.uint64(BLOCK_BITS - 1) for i in range(PROBES)]

    @staticmethod
    def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
        return keys >> np.uint64(65 - blocks.bit_length()) if blocks > 1 else np.zeros_like(keys)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: probes go on until one is missing."""
        out = np.zeros(len(keys), np.int64)
        base = (self.block_of(keys, self.blocks) - np.uint64(self.first)) * np.uint64(BLOCK_BITS)
        active = np.arange(len(keys))
        for level in range(1, LEVELS + 1):
            hit = np.ones(len(active), bool)
            for place in self.places(keys[active], level):
                at = base[active] + place
                hit &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            active = active[hit]
            if not len(active):
                break
            out[active] = level
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _MEANING[self.level(keys)]


def build_block(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bytes of one block that holds these n-grams."""
    q = levels(n)
    bits = np.zeros(BLOCK_BITS, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        for place in Filter.places(keys[q >= level], level):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


def build_blocks(found: list[tuple], blocks: int, first: int, many: int) -> np.ndarray:
    """The bytes of ``many`` blocks from the block ``first`` on, out of decoded rows that have them all."""
    keys = np.concatenate([np.empty(0, np.uint64), *[f[i] for f in found for i in (0, 2)]])
    n = np.concatenate([np.empty(0, np.int64), *[f[i] for f in found for i in (1, 3)]])
    order = np.argsort(keys)
    keys, n, wide = keys[order], n[order], BLOCK_BITS // 8
    bits = np.zeros(many * wide, np.uint8)
    for block, at in by_part(keys, blocks):
        bits[(block - first) * wide : (block - first + 1) * wide] = build_block(keys[at], n[at])
    return bits


def distinct_keys(texts) -> np.ndarray:
    """The sorted distinct n-grams of a column of texts."""
    found = [np.unique(np.concatenate(ngrams(words, at)[:2])) for _, _, words, at in chunk_words(texts, WHITE)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


@dataclass
class LanguageModel:
    #: None if the filter is too large to be in one place.
    filter: Filter | None
    blocks: int
    tokens: int
    distinct: int
    #: Counts from here on are in the frequent table.
    frequent_from: int
    frequent: np.ndarray
    frequent_counts: np.ndarray

    def known_counts(self, keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exact counts of the frequent words, which of the others can have been seen)."""
        place = np.searchsorted(self.frequent, keys)
        place[place == len(self.frequent)] = 0
        often = self.frequent[place] == keys if len(self.frequent) else np.zeros(len(keys), bool)
        exact = np.where(often, self.frequent_counts[place] if len(self.frequent) else 0, 0)
        # All words are in the filter: one that is missing there was not in the training texts.
        return exact, ~often & (level > 0)

    def score(self, words: np.ndarray, at: np.ndarray, level_of, count_of):
        """For each text: tokens, base sum and known tokens of the words with an exact count, log10
        probability, and the keys of the words whose exact count is open.

        ``level_of`` gives the levels that the filter has for keys, ``count_of`` the exact counts of
        words, and which of them are open."""
        one, two, first = ngrams(words, at)
        total = self.tokens + self.distinct + 1
        keys, back = np.unique(one, return_inverse=True)
        level = level_of(keys)
        c = _MEANING[level][back]
        pairs, pair_back = np.unique(two, return_inverse=True)
        c2 = _MEANING[level_of(pairs)][pair_back]
        before = np.roll(c, 1)
        before[first] = _MEANING[level_of(np.array([END & ~_ODD]))][0]
        p = (c2 + MU * (c + 1) / total) / (np.maximum(before, c2) + MU)
        probability = np.add.reduceat(np.log10(p), first)

        exact, open_ = count_of(keys, level)
        base = np.add.reduceat(np.log10(exact + 1.0)[back], first)
        known = np.add.reduceat((exact > 0)[back].astype(np.int64), first)
        open_ = open_[back]
        sizes = np.diff(np.append(first, len(one)))
        rare = one[open_]
        rare_at = np.concatenate(([0], np.cumsum(open_)))[np.append(first, len(one))]
        return sizes, base, known, probability, rare, rare_at

    def columns(self, texts, level_of, count_of) -> list[pa.Array]:
        """The columns ``NEW`` of a column of texts."""
        found = [self.score(words, at, level_of, count_of) for _, _, words, at in chunk_words(texts, WHITE)]
        cat = lambda i, kind: np.concatenate([f[i] for f in found]) if found else np.empty(0, kind)
        rare, step, at = cat(4, np.uint64), 0, [np.zeros(1, np.int64)]
        for f in found:
            at.append(f[5][1:] + step)
            step += len(f[4])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(at).astype(np.int32)), pa.array(rare.view(np.int64)))
        return [
            pa.array(cat(0, np.int64)), pa.array(cat(1, np.float64)), pa.array(cat(2, np.int64)),
            pa.array(cat(3, np.float64)), lists,
        ]


def fit(grams: DataFrame) -> LanguageModel:
    """The model of a stored table of packed n-grams."""
    levels_ = F.posexplode(F.arrays_zip("word_levels", "pair_levels", "least")).alias("level", "of")
    rows = (
        grams.select(levels_).groupBy("level")
        .agg(F.sum("of.word_levels").alias("words"), F.sum("of.pair_levels").alias("pairs"), F.min("of.least").alias("least"))
        .collect()
    )
    tokens = grams.agg(F.sum("tokens")).first()[0] or 0
    inserts = sum((r["words"] + r["pairs"]) * r["level"] for r in rows)
    blocks = 1
    while blocks * BLOCK_BITS < inserts * INSERT_BITS:
        blocks *= 2

    # The most frequent words, whole levels at a time.
    frequent_from, size = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["level"]):
        size += r["words"]
        if size > FREQUENT:
            break
        if r["words"]:
            frequent_from = r["least"]

    held = None
    if blocks * BLOCK_BITS <= FILTER_BITS:
        # As many groups of whole blocks as there are parts, at most.
        parts = grams.agg(F.max("parts")).first()[0] or 1
        groups = min(parts, blocks)
        many = blocks // groups

        def make(rows):
            group = rows["group"][0].as_py()
            bits = build_blocks([decode(r) for r in rows.to_pylist()], blocks, group * many, many)
            return pa.table({"group": pa.array([group], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

        own = F.floor(F.col("part") / (parts // groups)).alias("group")
        built = grams.select(own, "words", "word_n", "pairs", "pair_n").groupBy("group").applyInArrow(make, "group long, bits binary")
        bits = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
        wide = many * BLOCK_BITS // 8
        for batch in built.toArrow().to_batches():
            for g, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bits[g * wide : (g + 1) * wide] = np.frombuffer(raw.as_buffer(), np.uint8)
        held = Filter(blocks, bits)
    often = word_counts(grams, frequent_from, 1 << 62).toArrow()
    keys = often["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return LanguageModel(
        held, blocks, int(tokens), sum(r["words"] for r in rows), frequent_from, keys[order], often["n"].to_numpy()[order]
    )


NEW = [
    T.StructField("n_tokens", T.LongType()), T.StructField("_base", T.DoubleType()),
    T.StructField("_known", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("_rare", T.ArrayType(T.LongType())),
]


def _free_shuffles(spark) -> None:
    """Let Spark's cleaner delete the files of shuffles that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def _score_by_shards(docs: DataFrame, grams: DataFrame, model: LanguageModel, shared) -> DataFrame:
    """``docs`` with the columns ``NEW``, read from a filter that is cut into shards."""
    blocks = model.blocks
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = grams.agg(F.max("parts")).first()[0] or 1
    shards = min(max(1, blocks * BLOCK_BITS // SHARD_BITS), parts, blocks)
    in_shard, units = blocks // shards, max(1, -(-(sizes["bytes"] or 0) // UNIT_BYTES))
    # The counted n-grams are written; their shuffle can go.
    _free_shuffles(docs.sparkSession)

    # Any row can go to any unit; its place in the input says to which. Columns go by their places.
    text = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]
    unit = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(units))
    dealt = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], unit.alias("unit"))
    # Two steps read these rows; dealt out once, they are one shuffle.
    dealt = dealt.repartition("unit")

    def ask(rows):
        words, pairs = split_kinds(distinct_keys(rows[f"c{text}"].combine_chunks()))
        asks = {}
        for at_, keys, shift in ((0, words, _ODD), (1, pairs, _PAIR_SHIFT)):
            for shard, at in by_part(keys, shards):
                asks.setdefault(shard, [b"", b""])[at_] = pack(keys[at], shift)
        own = rows["unit"][0].as_py()
        return pa.table(
            {
                "shard": pa.array(list(asks), pa.int64()), "unit": pa.array([own] * len(asks), pa.int64()),
                "words": pa.array([a[0] for a in asks.values()], pa.binary()),
                "pairs": pa.array([a[1] for a in asks.values()], pa.binary()),
            }
        )

    def answer(rows, asks):
        out = {"unit": [], "shard": [], "word_levels": [], "pair_levels": [], "word_n": []}
        if len(asks):
            shard = asks["shard"][0].as_py()
            found = [decode(r) for r in rows.to_pylist()]
            filter_ = Filter(blocks, build_blocks(found, blocks, shard * in_shard, in_shard), shard * in_shard)
            held = np.concatenate([np.empty(0, np.uint64), *[f[0] for f in found]])
            order = np.argsort(held)
            held, n = held[order], np.concatenate([np.empty(0, np.int64), *[f[1] for f in found]])[order]
            for row in asks.to_pylist():
                words, pairs = unpack(row["words"], _ODD), unpack(row["pairs"], _PAIR_SHIFT) | _ODD
                exact = np.zeros(len(words), np.int64)
                if len(held):
                    place = np.minimum(np.searchsorted(held, words), len(held) - 1)
                    exact = np.where(held[place] == words, n[place], 0)
                out["unit"].append(row["unit"])
                out["shard"].append(shard)
                out["word_levels"].append(filter_.level(words).astype(np.uint8).tobytes())
                out["pair_levels"].append(filter_.level(pairs).astype(np.uint8).tobytes())
                out["word_n"].append(pack_counts(exact))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})

    asks = dealt.groupBy("unit").applyInArrow(ask, "shard long, unit long, words binary, pairs binary")
    own = F.floor(F.col("part") / (parts // shards)).alias("shard")
    held = grams.select(own, "words", "word_n", "pairs", "pair_n")
    answers = held.groupBy("shard").cogroup(asks.groupBy("shard")).applyInArrow(
        answer, "unit long, shard long, word_levels binary, pair_levels binary, word_n binary"
    )

    kept = [n for i, n in enumerate(names) if i != text]
    made = [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(NEW)]
    schema = T.StructType([f for f in dealt.schema.fields if f.name in kept] + made)

    def solve(rows, answers):
        column = rows[f"c{text}"].combine_chunks()
        keys = distinct_keys(column)
        words, pairs = split_kinds(keys)
        answers = answers.sort_by("shard").to_pylist()
        level = np.empty(len(keys), np.int64)
        odd = (keys & _ODD).astype(bool)
        for name, own in (("word_levels", ~odd), ("pair_levels", odd)):
            level[own] = np.frombuffer(b"".join(a[name] for a in answers), np.uint8)
        n = [unpack_counts(a["word_n"], len(a["word_levels"])) for a in answers]
        n = np.concatenate([np.empty(0, np.int64), *n])
        new = shared.value.columns(
            column, lambda x: level[np.searchsorted(keys, x)],
            lambda x, _: (n[np.searchsorted(words, x)], np.zeros(len(x), bool)),
        )
        return pa.table({**{c: rows[c] for c in kept}, **{f"n{i}": x for i, x in enumerate(new)}})

    solved = dealt.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(solve, schema)
    taken = {f.name.lower() for f in NEW} | {"text"}
    return solved.select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True) if c.lower() not in taken],
        *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(NEW)],
    )


def score(docs: DataFrame, train: Column, least_pairs: int = 2) -> DataFrame:
    """``docs`` scored by a model of the rows for which ``train`` holds; bigrams of ``least_pairs`` or more are stored.

    New columns: n_tokens, n_known, train_tokens, base_score and score.
    """
    spark = docs.sparkSession
    grams = stored(counts(docs.filter(train), least_pairs), "grams")
    model = fit(grams)
    shared = spark.sparkContext.broadcast(model)
    total = float(np.log10(model.tokens + model.distinct + 1))
    base = F.col("_base") - F.col("n_tokens") * F.lit(total)
    whole = F.lit(model.tokens).cast("long")

    if model.filter is None:
        scored = _score_by_shards(docs, grams, model, shared)
        return scored.withColumns({"n_known": F.col("_known"), "train_tokens": whole, "base_score": base}).drop(
            "_base", "_known", "_rare"
        )

    def make():
        m = shared.value
        return lambda texts: m.columns(texts, m.filter.level, m.known_counts)

    # One row number a row: ids may repeat.
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    scored = stored(append_columns(numbered, make, NEW, ["text"]).drop("text"), "scored")
    rare = word_counts(grams, 1, model.frequent_from)
    exact = (
        scored.select("_row", F.explode("_rare").alias("key"))
        .join(rare, "key")
        .groupBy("_row")
        .agg(F.sum(F.log10(F.col("n") + 1)).alias("_more"), F.count(F.lit(1)).alias("_also"))
    )
    return (
        scored.join(exact, "_row", "left")
        .withColumns(
            {
                "n_known": F.col("_known") + F.coalesce("_also", F.lit(0)),
                "train_tokens": whole,
                "base_score": base + F.coalesce("_more", F.lit(0.0)),
            }
        )
        .drop("_row", "_base", "_known", "_rare", "_more", "_also")
    )
