"""Tables kept in buckets by a key, so that joins and lookups by it move no rows.

Rows are written once into as many buckets as their number asks for, sorted by key. Rows of keys that
would fill a bucket alone, and rows without a key, are kept apart, dealt as they came: no bucket holds more than the
even share plus what one key may add. Tables that are to be joined share buckets and the list of such keys.

Defined cases: a NULL key matches nothing and its row stays in a left join; rows that repeat, on either side, give
every pair, as a join does; an empty table has empty buckets.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.lookup import BROADCAST_BYTES, SALTS, row_bytes
from riskweave.session import new_folder, stored

BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 16


@dataclass
class Bucketed:
    name: str  # in the session's catalog
    even: DataFrame
    apart: DataFrame
    key: str
    buckets: int
    hot: list

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.apart)

    def lookup(self, keys: Sequence) -> DataFrame:
        """The rows of some keys; only their buckets are read, and what is kept apart if a key is there."""
        keys = [k for k in keys if k is not None]
        out = self.even.filter(F.col(self.key).isin(keys))
        frequent = [k for k in keys if k in self.hot]
        return out.unionByName(self.apart.filter(F.col(self.key).isin(frequent))) if frequent else out

    def drop(self) -> None:
        """Take the table out of the catalog; its files go when folders are released."""
        self.even.sparkSession.sql(f"drop table if exists {self.name}")


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, math.ceil(rows / BUCKET_ROWS))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) of a table, written once: its size and its frequent keys both come from here."""
    return stored(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "counts")


def hot_keys(counts: DataFrame, key: str, buckets: int, rows: int) -> list:
    """Keys with more rows than a bucket's even share; fewer than there are buckets."""
    hot = counts.filter(F.col(key).isNotNull() & (F.col("_n") > max(1, rows / buckets)))
    return sorted(r[0] for r in hot.select(key).collect())


def store(df: DataFrame, key: str, buckets: int, hot: Sequence = ()) -> Bucketed:
    """Write a table into buckets; rows of ``hot`` keys and rows without a key go apart."""
    spark, hot = df.sparkSession, list(hot)
    away: Column = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    name = f"buckets_{uuid.uuid4().hex}"
    (
        df.filter(~away)
        .repartition(buckets, key)
        .write.format("parquet")
        .option("path", new_folder(spark, "buckets"))
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return Bucketed(name, spark.table(name), stored(df.filter(away), "apart"), key, buckets, hot)


def store_pair(left: DataFrame, right: DataFrame, key: str, buckets: int | None = None) -> tuple[Bucketed, Bucketed]:
    """Both tables in the same buckets, with the frequent keys of either kept apart in both.

    Each is read three times; one that is costly to derive is better ``stored`` first.
    """
    counted = [key_counts(df, key) for df in (left, right)]
    sizes = [c.agg(F.sum("_n")).first()[0] or 0 for c in counted]
    n = buckets or buckets_for(max(sizes))
    hot = sorted({k for c, rows in zip(counted, sizes) for k in hot_keys(c, key, n, rows)})
    return store(left, key, n, hot), store(right, key, n, hot)


def left_join(left: Bucketed, right: Bucketed, limit: int | None = None) -> DataFrame:
    """Every row of ``left`` with the columns of ``right``: bucket by bucket, without a shuffle.

    Rows kept apart meet those of ``right`` by a broadcast of at most ``limit`` bytes (``BROADCAST_BYTES``), counted;
    a larger side is copied to ``SALTS`` salts, over which the rows of a key are dealt.
    """
    if (left.key, left.buckets, left.hot) != (right.key, right.buckets, right.hot):
        raise ValueError("tables in different buckets")
    key = left.key
    even = left.even.hint("merge").join(right.even.hint("merge"), key, "left")
    few = right.apart.filter(F.col(key).isNotNull())
    size = few.agg(F.sum(row_bytes(few))).first()[0] or 0
    if size <= (BROADCAST_BYTES if limit is None else limit):
        return even.unionByName(left.apart.join(F.broadcast(few), key, "left"))
    # Rows of stored files keep their place, so a task that runs again deals them alike.
    dealt = left.apart.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # A NULL key would be dealt by its hash alone; it goes by its salt like the others.
    return even.unionByName(dealt.join(copies, [key, "_salt"], "left").drop("_salt"))
