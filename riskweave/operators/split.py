"""Splits as projections: find the boundary row, then compare each row with it.

No row is moved or numbered. The boundary search (``order.values_at_ranks``)
shuffles only values near the wanted rank. Ties in time are broken by key. Rows without a
time come first, as in an ascending order, and a missing key comes before all others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import hash60, ratio, seeded_md5
from riskweave.operators.order import values_at_ranks
from riskweave.session import stored
from riskweave.sources import schema as S


@dataclass(frozen=True)
class Boundary:
    """Where a head of fixed size ends, by (major, minor).

    Without a minor part the head ends between two major values; without a major part
    it holds all rows.
    """

    major: object
    minor: object

    def precedes(self, major: Column, minor: Column) -> Column:
        """True for rows of the head."""
        if self.major is None:
            return F.lit(True)
        if self.minor is None:
            return major < F.lit(self.major)
        return (major < F.lit(self.major)) | (
            (major == F.lit(self.major)) & (minor < F.lit(self.minor))
        )


def boundaries(df: DataFrame, major: str, minor: str, ranks: list[int], n: int) -> list[Boundary]:
    """For each rank: a boundary that exactly ``rank`` rows precede."""
    inner = [r for r in ranks if 0 <= r < n]
    found = dict(zip(inner, values_at_ranks(df, major, inner, n))) if inner else {}
    out = []
    for r in ranks:
        if r not in found:
            out.append(Boundary(None, None))
            continue
        value, below, at = found[r]
        if r == below:
            out.append(Boundary(value, None))
            continue
        tied = df.filter(F.col(major) == F.lit(value))
        if dict(df.dtypes)[minor] == "string":
            # Digests behind one 60-bit prefix: a handful, whatever the number of rows. Rows
            # with one digest stay together.
            digests = tied.groupBy(minor).agg(F.count(F.lit(1)).alias("n")).orderBy(minor).collect()
            left = r - below
            for low, size in digests:
                left -= size
                if left < 0:
                    break
        else:
            low = values_at_ranks(tied, minor, [r - below], at)[0][0]
        out.append(Boundary(value, low))
    return out


#: Stands for a missing time or key, below all real ones.
MISSING = -(1 << 63) + 1


def time_boundaries(df: DataFrame, ranks: list[int], n: int) -> list[Boundary]:
    places = [F.coalesce(F.col(c).cast("bigint"), F.lit(MISSING)).alias(c) for c in (S.TIME, S.KEY)]
    return boundaries(df.select(*places), S.TIME, S.KEY, ranks, n)


def in_head(b: Boundary) -> Column:
    time, key = F.col(S.TIME), F.coalesce(S.KEY, F.lit(MISSING))
    if b.major is None:
        return F.lit(True)
    if b.major == MISSING:
        return F.lit(False) if b.minor is None else time.isNull() & (key < F.lit(b.minor))
    return time.isNull() | b.precedes(time, key)


def temporal_head(df: DataFrame, share: float = 0.75) -> DataFrame:
    """The first ``share`` of the rows by time; the row count is rounded."""
    n = df.count()
    (b,) = time_boundaries(df, [math.floor(n * share + 0.5)], n)
    return df.filter(in_head(b))


def temporal_split(df: DataFrame, train_frac: float = 0.75, val_frac: float = 0.20) -> DataFrame:
    """Add ``split``: train, then val, then test, in time order, never shuffled."""
    n = df.count()
    train_end = int(n * train_frac)
    val_start = int(train_end * (1 - val_frac))
    first, second = time_boundaries(df, [val_start, train_end], n)
    return df.withColumn(
        "split", F.when(in_head(first), "train").when(in_head(second), "val").otherwise("test")
    )


def stratified_carve(
    pool: DataFrame, val_frac: float = 0.20, seed: int = 42, label: str = S.LABEL
) -> Column:
    """Predicate of the validation rows: the exact share of each class, by key digest.

    Each class contributes its ceil(share) rows with the smallest digests.
    """
    # Digests are made once; every pass that looks for a rank reads the numbers.
    keyed = stored(
        pool.select(F.col(S.KEY).alias("_key"), F.col(label).alias("_y"), hash60(F.col(S.KEY), seed).alias("_h")), "digests"
    ).select("_y", "_h", seeded_md5(F.col("_key"), seed).alias("_md5"))
    counts = dict(keyed.groupBy("_y").count().collect())
    chosen = F.lit(False)
    for c in (0, 1):
        n = counts.get(c, 0)
        if not n:
            continue
        take = math.ceil(round(n * val_frac, 9))
        (b,) = boundaries(keyed.filter(F.col("_y") == c), "_h", "_md5", [take], n)
        inside = b.precedes(hash60(F.col(S.KEY), seed), seeded_md5(F.col(S.KEY), seed))
        chosen = chosen | ((F.col(label) == c) & inside)
    return chosen


def prepare_splits(
    df: DataFrame, train_frac: float = 0.75, val_frac: float = 0.20, seed: int = 42
) -> DataFrame:
    """Test = the last part by time; validation = a stratified carve from the rest."""
    n = df.count()
    (b,) = time_boundaries(df, [int(n * train_frac)], n)
    is_val = stratified_carve(df.filter(in_head(b)), val_frac, seed)
    return df.withColumn(
        "split", F.when(~in_head(b), "test").when(is_val, "val").otherwise("train")
    )


def ts_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Add ``block``: fold i tests on block i and trains on all earlier blocks."""
    n = df.count()
    size = n // (folds + 1)
    starts = [n - (folds - i) * size for i in range(folds)]
    block = F.lit(0)
    for b in time_boundaries(df, starts, n):
        block = block + F.when(in_head(b), 0).otherwise(1)
    return df.withColumn("block", block)


def split_summary(split: DataFrame, label: str = S.LABEL) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(label).alias("label_rate")
    )


def split_check(split: DataFrame, source: DataFrame) -> DataFrame:
    """Rows conserved, splits disjoint, every key in one split only."""
    per_key = split.groupBy(S.KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("split").alias("lo"),
        F.max("split").alias("hi"),
    )
    return per_key.agg(
        F.sum("n").alias("split_rows"),
        F.count_if(F.col("lo") != F.col("hi")).alias("keys_in_two_splits"),
    ).crossJoin(F.broadcast(source.agg(F.count(F.lit(1)).alias("source_rows"))))


def sample_n(df: DataFrame, n: int, seed: int) -> DataFrame:
    """A repeatable sample of ``n`` rows without replacement, by key digest.

    Rows that share a key are taken or left together: with repeated keys the sample is the
    largest set of whole keys, in digest order, of at most ``n`` rows.
    """
    total = df.count()
    if n >= total:
        return df
    keyed = df.select(
        hash60(F.col(S.KEY), seed).alias("_h"), seeded_md5(F.col(S.KEY), seed).alias("_md5")
    )
    (b,) = boundaries(keyed, "_h", "_md5", [n], total)
    return df.filter(b.precedes(hash60(F.col(S.KEY), seed), seeded_md5(F.col(S.KEY), seed)))


def sample_share(df: DataFrame, share: float, seed: int) -> DataFrame:
    """A repeatable share of the rows: digests below ``share`` of the digest space."""
    return df.filter(hash60(F.col(S.KEY), seed) < F.lit(int(share * (1 << 60))))


def class_balance(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Class counts, positive weight n0/n1, and balanced weights n/(2 n_c)."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(n0.alias("n_negative"), n1.alias("n_positive")).withColumns(
        {
            "scale_pos_weight": F.try_divide(F.col("n_negative"), F.col("n_positive")),
            "fraud_rate": ratio(F.col("n_positive"), F.col("n_negative") + F.col("n_positive")),
        }
    )
