"""Scans and sinks: typed CSV loads, projected scans, partitioned logs, feature tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import nan_to_null
from riskweave.sources import schema as S


def input_path(root: str, prefix: str, name: str) -> str:
    """Join the parts with single slashes, whatever slashes they bring along."""
    parts = [root.rstrip("/"), prefix.strip("/"), name.lstrip("/")]
    return "/".join(p for p in parts if p)


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """The engine knows NULL only; NaN becomes NULL once, at ingest."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            nan_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, floats) else f.name
            for f in df.schema
        ]
    )


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Declared types, empty cell = NULL, and a bad cell fails the read.

    ``multiline`` allows line breaks inside quotes but makes a file unsplittable.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return nulls_for_nans(df)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, target: str, multiline: bool = False
) -> DataFrame:
    """Truncate-and-replace load of a CSV file into a Parquet table."""
    replace_table(read_typed_csv(spark, path, schema, multiline), target)
    return current_table(spark, target)


POINTER = "_current"


def replace_table(df: DataFrame, path: str) -> None:
    """Create or replace a table: all of the new one, or still the old one.

    Rows are written to a folder of their own; then one small file that names the folder is put in
    place by a rename. A write that fails leaves the old table as it was, and whoever began to read
    it goes on with its files: the folder before the current one stays until the next replacement.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    before = _version(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    fresh, pointer = fs_path(f"{path}/_{version}"), fs_path(f"{path}/{POINTER}")
    fs = pointer.getFileSystem(conf)
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(fresh), fs.makeQualified(pointer), how
    )
    for status in fs.listStatus(fs_path(path)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            fs.delete(status.getPath(), True)


def _version(spark: SparkSession, path: str) -> str | None:
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    fs = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readNBytes(200)).decode()
    finally:
        stream.close()


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``replace_table`` put there last."""
    version = _version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path}/{version}")


def labelled(df: DataFrame, columns: Sequence[str], label: str = S.LABEL) -> DataFrame:
    return df.select(*columns).filter(F.col(label).isNotNull())


def in_time_order(df: DataFrame, time: str = S.TIME, key: str = S.KEY) -> DataFrame:
    return df.filter(F.col(S.LABEL).isNotNull()).orderBy(time, key)


def eda_scan(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    out = df.select(*columns)
    return out if limit is None else out.limit(limit)


# --- day-partitioned logs ------------------------------------------------------------


def append_log(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Append to a log that is partitioned by calendar day.

    Rows are rebalanced by day: small days share a task, a heavy day is split.
    """
    (
        df.withColumn("date", F.to_date(time))
        .hint("rebalance", F.col("date"))
        .write.mode("append")
        .partitionBy("date")
        .parquet(path)
    )


def read_log(
    spark: SparkSession, path: str, schema: T.StructType, since: dt.datetime | None = None
) -> DataFrame:
    """Log rows since an instant; the matching day filter prunes partitions.

    Days are those of the session's time zone, in which the log was partitioned, whatever
    zone ``since`` is given in.
    """
    full = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    df = spark.read.schema(full).parquet(path)
    if since is not None:
        day = F.to_date(F.lit(since))
        df = df.filter((F.col("date") >= day) & (F.col("timestamp") >= F.lit(since)))
    return df


def trailing_window(
    df: DataFrame, as_of: dt.datetime, days: float = 0, hours: float = 0, time: str = "timestamp"
) -> DataFrame:
    """Rows from the window that ends at ``as_of`` (a parameter, never the wall clock)."""
    start = as_of - dt.timedelta(days=days, hours=hours)
    return df.filter((F.col(time) >= F.lit(start)) & (F.col(time) <= F.lit(as_of)))


# --- keyed feature table ----------------------------------------------------------------


def registered_only(df: DataFrame, key: str, time: list[str]) -> DataFrame:
    """Key, time and registered features, cast to their registered types."""
    have = set(df.columns)
    feats = [
        F.col(n).cast(S.SPARK_TYPE[t]).alias(n)
        for n, t in S.REGISTERED_FEATURES
        if n in have and n != key
    ]
    return df.select(key, *[c for c in time if c != key], *feats)


def upsert_features(current: DataFrame, batch: DataFrame, key: str, time: list[str]) -> DataFrame:
    """Latest row per key wins. Aggregated map-side, so a hot key costs no big group."""
    both = current.unionByName(batch, allowMissingColumns=True)
    rest = [c for c in both.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*time)).alias("r")
    return both.groupBy(key).agg(newest).select(key, *[f"r.{c}" for c in rest])


def lookup_features(
    features: DataFrame, ids: DataFrame, key: str, feature_ids: Sequence[str]
) -> DataFrame:
    """Chosen features of the listed entities."""
    return features.select(key, *feature_ids).join(ids.select(key), key, "left_semi")


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.REGISTERED_FEATURES, "feature string, value_type string")


def unregistered(found: DataFrame, known: DataFrame) -> DataFrame:
    """Features seen in the data that the registry does not know yet."""
    return found.join(F.broadcast(known.select("feature")), "feature", "left_anti")
