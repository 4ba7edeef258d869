"""A stored table of the latest features of each key, in buckets by key.

The table is a folder of Parquet files, ``bucket=<n>/...``, by a hash of the key; files are sorted by
key and carry a Bloom filter of it. A merge rewrites only the buckets that its batch touches,
and a lookup reads only the buckets of its keys (and, of few keys, only row groups that may
hold one). How many buckets a table has is set when it is made: about a task's worth of rows each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import exists, stored
from riskweave.sources.tables import lookup_features, upsert_features

BUCKETS = 64
# Keys that a lookup hands to the scan as literals, at most.
LISTED = 1_000


@dataclass
class FeatureStore:
    """``time`` has the columns by which the latest row of a key is told."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    time: Sequence[str]
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The stored rows, of some buckets or of all."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(whole).parquet(self.path)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin([*buckets] or [-1]))
        return rows.drop("bucket")

    def _touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` are in; one number each."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def merge(self, batch: DataFrame) -> None:
        """Upsert: the latest row of each key stays. Rows without a key are left out."""
        names = self.schema.names
        batch = batch.filter(F.col(self.key).isNotNull()).select(*names)
        current = self.read([])
        if exists(self.spark, self.path):
            batch = stored(batch, "batch")  # read for its buckets and for its rows
            current = self.read(self._touched(batch))
        merged = upsert_features(current, batch, self.key, list(self.time)).select(*names)
        (
            merged.withColumn("bucket", self.bucket())
            .hint("rebalance", F.col("bucket"))
            .sortWithinPartitions("bucket", self.key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .partitionBy("bucket")
            .parquet(self.path)
        )

    def lookup(self, ids: DataFrame, feature_ids: Sequence[str]) -> DataFrame:
        """Chosen features of the listed keys; ``ids`` has the key."""
        wanted = ids.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        rows = self.read(self._touched(wanted))
        few = [r[0] for r in wanted.limit(LISTED + 1).collect()]
        if len(few) <= LISTED:
            return rows.filter(F.col(self.key).isin(few)).select(self.key, *feature_ids)
        return lookup_features(rows, wanted, self.key, feature_ids)
