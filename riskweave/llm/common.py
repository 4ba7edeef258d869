"""Helpers the operators of this folder share: tables, samples, and word hashes over Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text handled at once by the vectorised code, in bytes (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20
#: Input of ``append_columns`` that is answered at once, in bytes (one row at least).
SLICE_BYTES = 4 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    keep: Column | None,
    bound: int,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """About ``bound`` labelled texts at most: (doc_id, text, y).

    Ids are chosen by their hash, rarer class first: each class gets half the bound, and a
    class with fewer rows gives all it has. Repeated labels of an id count once, as the
    highest; rows without id or label are left out. Only the chosen ids, a bounded list,
    are joined to the texts, so the texts are not shuffled.
    """
    marks = labels.select("doc_id", F.col(target).alias("y")).dropna()
    if keep is not None:
        marks = marks.filter(keep)
    marks = marks.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = bound // 2
    wide = 1 << 20
    share = F.lit(0)
    for y, n in sizes.items():
        other = sum(sizes.values()) - n
        room = half if other >= half else bound - other
        share = F.when(F.col("y") == y, F.lit(int(wide * min(1.0, room / max(n, 1))))).otherwise(share)
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(wide)) < share)
    return docs.select("doc_id", "text", *extra).join(F.broadcast(chosen), "doc_id")


def byte_class(separators: bytes | None = None) -> np.ndarray:
    """True for each byte that separates words; by default all but letters, digits and non-ASCII."""
    table_ = np.zeros(256, bool)
    if separators is not None:
        table_[list(separators)] = True
    else:
        table_[:128] = [not chr(b).isalnum() for b in range(128)]
    return table_


WHITE = byte_class(b" \t\n\x0b\x0c\r")
PUNCT = byte_class()


def mix(x: np.ndarray) -> np.ndarray:
    """A strong 64-bit mix, elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _byte_values() -> np.ndarray:
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += 32  # A-Z as a-z
    return mix(lower + np.uint64(1)) | np.uint64(1)


_VALUES = _byte_values()
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.full(size, _MULT), np.full(size, _INV)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def word_hashes(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of a byte array, A-Z as a-z, and where each word starts."""
    split = separators[data]
    starts = np.flatnonzero(~split & np.concatenate(([True], split[:-1])))
    if not len(starts):
        return np.empty(0, np.uint64), starts
    up, down = _power_tables(len(data))
    values = _VALUES[data] * up[: len(data)]
    values[split] = 0
    return mix(np.add.reduceat(values, starts) * down[starts]), starts


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of an Arrow string column; null is empty.

    Rows are followed by one blank, so no word reaches over two rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    at = np.frombuffer(at, wide)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), n)
        sizes = np.diff(at[first : end + 1])
        offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
        buf = np.full(offsets[-1], 32, np.uint8)
        keep = np.ones(offsets[-1], bool)
        keep[offsets[1:] - 1] = False
        buf[keep] = data[at[first] : at[end]]
        yield first, end, buf, offsets
        first = end


def chunk_words(column: pa.Array, separators: np.ndarray):
    """(first row, end row, word hashes, first word of each row and the end) of each chunk."""
    for first, end, buf, offsets in text_chunks(column):
        words, starts = word_hashes(buf, separators)
        yield first, end, words, np.searchsorted(starts, offsets)


#: Keys a task gathers before it passes their counts on.
GATHER = 1 << 21


def count_keys(texts: DataFrame, separators: np.ndarray, keys_of) -> DataFrame:
    """(key, n): how often ``keys_of(words, first word of each text)`` names each key.

    Tasks count what they gather before the shuffle, so a frequent key is a few rows.
    """

    def run(batches):
        held, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(keys), 1 << 18):
                b = a + (1 << 18)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b].view(np.int64)), pa.array(n[a:b])], names=["key", "n"]
                )

        for batch in batches:
            for _, _, words, at in chunk_words(batch.column(0), separators):
                keys = keys_of(words, at)
                held.append(keys)
                size += len(keys)
                if size >= GATHER:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    parts = texts.select("text").mapInArrow(run, "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def append_columns(df: DataFrame, make, fields: list[T.StructField], reads: list[str]) -> DataFrame:
    """``df`` and new columns that ``make()`` computes batch by batch from the columns ``reads``.

    ``make`` is called once a task and returns a function from Arrow arrays to Arrow arrays.
    A column of ``df`` that has the name of a new one gives way to it, after it was read.
    """
    names = [f.name for f in fields]
    taken, inner = {n.lower() for n in names}, [f"n{i}" for i in range(len(names))]
    # Columns that are only carried along need no Python type; the task names them by place.
    kept = df.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    at = [df.columns.index(c) for c in reads]

    def run(batches):
        fn = make()
        for whole in batches:
            # In slices, so that what a batch makes is never held at once.
            rows = max(1, min(len(whole), len(whole) * SLICE_BYTES // max(whole.nbytes, 1)))
            for first in range(0, len(whole), rows):
                batch = whole.slice(first, rows)
                new = fn(*[batch.column(i) for i in at])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *new], names=[*batch.schema.names, *inner]
                )

    made = [T.StructField(n, f.dataType) for n, f in zip(inner, fields, strict=True)]
    schema = T.StructType([*kept.schema.fields, *made])
    out = kept.mapInArrow(run, schema)
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in taken],
        *[F.col(f"n{i}").alias(n) for i, n in enumerate(names)],
    )


def free_name(df: DataFrame, prefix: str, names: tuple[str, ...]) -> str:
    """A prefix with which none of ``names`` is a column of ``df`` yet."""
    taken = {c.lower() for c in df.columns}
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return prefix


def word_runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words."""
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for i in range(n):
        out = out * np.uint64(0x100000001B3) + words[i : len(out) + i]
    return out
