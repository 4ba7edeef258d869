"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms of medium document frequency over all texts: those in ``RARE`` to ``COMMON``
of them (and in two texts at least). A text has so many distinct terms on average, whatever the table,
so the lexicon has at most that number divided by ``RARE``: it does not grow with the table and is
broadcast. ``SUBSETS`` seeded subsets keep from a 16th to a 2048th of it; terms in none of them are not
kept. A fingerprint has one part a subset: the hash of the sorted distinct
terms of the text in that subset, or zeros if it has none there. The likeness of two
fingerprints is the share of equal parts among those that at least one of them has.

A text is also compared with its successor (the next row by doc_id, cyclically) and with an
edit of its own: the last half replaced by the beginning of the successor. For that, rows are
dealt in ranges of doc_id by one shuffle; the first row of a range also goes to the range
before it. No row, id or text passes through the driver but the ids of range borders.

Terms are runs of letters, digits and non-ASCII characters, A-Z as a-z. Defined cases: null is
the empty text; an empty text has an all-zero fingerprint, which is like another one; a text
without a term in any subset is hashed over all its terms, in every part; rows without doc_id
come last; rows that repeat a doc_id follow each other in the order in which they are read; a
single row is its own successor; an empty table gives no rows; very long texts are read whole, one at a time.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import PUNCT, count_keys, mix, word_hashes

#: The band, as shares of the texts: terms in more or in fewer of them are left out.
COMMON = 0.05
RARE = 0.0005
SUBSETS = 32
#: Subset j keeps a 2**-(FIRST_HALVING + j mod 8) share of the lexicon: small subsets meet in texts
#: that share a half, larger ones tell near copies apart.
FIRST_HALVING = 4
PART = 8
#: Rows sampled to choose the borders of ranges, at most about, and ranges a shuffle partition.
BORDER_SAMPLE = 50_000
RANGES = 4

_SEEDS = mix(np.arange(1, SUBSETS + 1, dtype=np.uint64))
_SHIFT = (64 - FIRST_HALVING - np.arange(SUBSETS) % 8).astype(np.uint64)


def terms(text: bytes) -> np.ndarray:
    return np.unique(word_hashes(np.frombuffer(text, np.uint8), PUNCT)[0])


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms in the band that are in a subset."""

    def distinct(words, at):
        return np.concatenate([np.unique(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)])

    def kept(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            keys = keys[chosen(keys).any(axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    total = docs.count()
    df = count_keys(docs, PUNCT, distinct)
    inside = df.filter((F.col("n") >= max(RARE * total, 2)) & (F.col("n") <= max(COMMON * total, 2)))
    return np.sort(inside.select("key").mapInArrow(kept, "key long").toArrow()["key"].to_numpy().view(np.uint64))


def chosen(found: np.ndarray) -> np.ndarray:
    """The subsets (columns) that each term is in."""
    return (mix(found[:, None] ^ _SEEDS) >> _SHIFT) == 0


def fingerprint(text: bytes, known: np.ndarray) -> str:
    found = terms(text)
    if not len(found):
        return "0" * (SUBSETS * PART)
    place = np.searchsorted(known, found)
    place[place == len(known)] = 0
    inside = found[known[place] == found] if len(known) else found[:0]
    subsets = chosen(inside)
    if not subsets.any():
        return f"{max(1, xxhash.xxh32_intdigest(found.tobytes())):08x}" * SUBSETS
    parts = []
    for column in np.ascontiguousarray(subsets.T):
        part = inside[column]
        # Zeros stand for no term.
        parts.append(f"{max(1, xxhash.xxh32_intdigest(part.tobytes())):08x}" if len(part) else "0" * PART)
    return "".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those that either fingerprint has."""
    if a == b:
        return 1.0
    none = "0" * PART
    pairs = [(a[i : i + PART], b[i : i + PART]) for i in range(0, SUBSETS * PART, PART)]
    some = [x == y for x, y in pairs if x != none or y != none]
    return sum(some) / len(some)


def _dealt(docs: DataFrame) -> DataFrame:
    """(range, late, doc_id, row, text): each range with the first row after it as a late one."""
    spark = docs.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    total = rows.count()
    wide = 1 << 30
    share = int(wide * min(1.0, BORDER_SAMPLE / max(total, 1)))
    keys = rows.filter(F.pmod(F.xxhash64("row"), F.lit(wide)) < share).select("doc_id", "row").toArrow()
    last = np.iinfo(np.int64).max
    ids = keys["doc_id"].fill_null(last).to_numpy()
    order = np.lexsort((keys["row"].to_numpy(), ids))
    pick = order[np.linspace(0, len(order), ranges, endpoint=False).astype(int)[1:]] if len(order) else order
    border_ids, border_rows = ids[pick], keys["row"].to_numpy()[pick]

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series, row: pd.Series) -> pd.Series:
        one, two = doc_id.to_numpy(), row.to_numpy()
        low, high = np.searchsorted(border_ids, one), np.searchsorted(border_ids, one, "right")
        out = low.copy()
        # A border inside the rows of one id divides them by their row number.
        for i in np.unique(one[low < high]):
            of = one == i
            a, b = low[of][0], high[of][0]
            out[of] = a + np.searchsorted(border_rows[a:b], two[of], "right")
        return pd.Series(out.astype(np.int32))

    key = F.coalesce("doc_id", F.lit(last))
    firsts = (
        rows.select(range_of(key, "row").alias("range"), key.alias("id"), "row")
        .groupBy("range")
        .agg(F.min(F.struct("id", "row")).alias("first"))
        .orderBy("range")
        .collect()
    )
    before = [(r["first"]["row"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    also = spark.createDataFrame(before, "row long, also int")
    out = rows.withColumn("range", range_of(key, "row")).join(F.broadcast(also), "row", "left")
    target = F.when(F.col("also").isNull(), F.array(F.struct(F.col("range"), F.lit(0).alias("late")))).otherwise(
        F.array(F.struct(F.col("range"), F.lit(0).alias("late")), F.struct(F.col("also").alias("range"), F.lit(1).alias("late")))
    )
    return out.select(F.explode(target).alias("to"), "doc_id", key.alias("id"), "row", "text").select(
        "to.range", "to.late", "id", "row", "doc_id", "text"
    )


def edit(text: str, after: str) -> bytes:
    """The text with its last half replaced by the beginning of its successor."""
    n = len(text)
    return (text[: n - n // 2] + after[: n // 2]).encode("utf-8", "surrogatepass")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, and their likeness; see the module's text."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = spark.sparkContext.broadcast(lexicon(docs))
    dealt = _dealt(docs)

    def run(batches):
        words = known.value
        held = None
        out = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("range", "late", "doc_id")]
            for at, (range_, late, doc_id) in enumerate(zip(*columns, strict=True)):
                text = batch.column("text")[at].as_py()
                print_ = fingerprint(text.encode("utf-8", "surrogatepass"), words)
                if held is not None and held[0] == range_:
                    out.append(pair(held, text, print_, words))
                held = None if late else (range_, doc_id, text, print_)
                if len(out) >= 512:
                    yield rows_of(out)
                    out = []
        if out:
            yield rows_of(out)

    def pair(held, next_text, next_print, words):
        _, doc_id, text, own = held
        n = len(text)
        edited = edit(text, next_text)
        changed = fingerprint(edited, words)
        return (
            doc_id, n, hashlib.sha256(edited).hexdigest(), own, changed,
            likeness(own, changed), likeness(own, next_print),
        )

    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def rows_of(found):
        columns = zip(*found, strict=True) if found else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names
        )

    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "range")
    return dealt.sortWithinPartitions("range", "late", "id", "row").mapInArrow(run, schema)
