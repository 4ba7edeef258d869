"""Joins and lookups over buckets: the same rows as a plain join, and plans that move none."""

import pytest
from pyspark.sql import functions as F

from riskweave.sources import buckets as B
from riskweave.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def skewed(spark):
    """A third of the rows has one key, a sixth has none; keys repeat on the right as well."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 != 1, F.col("id") % 90)
    left = spark.range(600).select(key.alias("k"), (F.col("id") % 50).alias("a"))
    right = spark.range(0, 120, 2).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 40 + F.when(F.col("id") < 40, 7).otherwise(0)).alias("k"), F.col("id").alias("b"))
    return left, right


def test_even_part_joins_without_exchange(spark, sf):
    left, right = B.store_pair(fx.txn(spark, sf), fx.identity(spark, sf), "TransactionID")
    assert left.hot == [] and left.buckets == 16
    p = plan(B.left_join(left, right))
    assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p and "SinglePartition" not in p
    # What is kept apart (rows without a key: none here) meets a counted broadcast.
    assert p.count("Exchange") == p.count("BroadcastExchange")


@pytest.mark.parametrize("limit", [None, 0])
def test_skewed_keys_give_the_rows_of_a_plain_join(spark, limit):
    left, right = skewed(spark)
    pair = B.store_pair(left, right, "k", 8)
    assert 7 in pair[0].hot and len(pair[0].hot) < 16
    out = B.left_join(*pair, limit=limit)
    assert out.columns == ["k", "a", "b"]
    assert rows(out) == rows(left.join(right, "k", "left"))
    assert pair[0].even.filter(F.col("k").isNull() | F.col("k").isin(pair[0].hot)).count() == 0
    assert rows(pair[0].rows()) == rows(left)


def test_lookup_reads_the_buckets_of_its_keys(spark):
    left, right = skewed(spark)
    one, _ = B.store_pair(left, right, "k", 8)
    assert rows(one.lookup([7, 8, None, 999])) == rows(left.filter("k in (7, 8)"))
    out = one.lookup([8])
    scan = out._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.optionalBucketSet().get().cardinality() == 1  # of eight
    assert "Exchange" not in plan(out)
    assert rows(one.lookup([])) == []


def test_empty_tables_and_unlike_buckets(spark):
    left, right = skewed(spark)
    none = B.store_pair(left.limit(0), right, "k", 8)
    assert B.left_join(*none).count() == 0
    bare = B.left_join(*B.store_pair(left, right.limit(0), "k", 8))
    assert bare.count() == 600 and bare.filter("b is not null").count() == 0
    with pytest.raises(ValueError):
        B.left_join(B.store(left, "k", 8), B.store(right, "k", 4))


def test_a_dropped_table_leaves_the_catalog(spark):
    one = B.store(skewed(spark)[0], "k", 4)
    assert spark.catalog.tableExists(one.name)
    one.drop()
    assert not spark.catalog.tableExists(one.name)
