"""Class imbalance: row weights, and synthetic minority rows from exact neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import any_of, hash60, hash_unit, seeded_md5
from riskweave.operators.lookup import State, lookup_join
from riskweave.operators.neighbours import nearest_vectors
from riskweave.operators.split import boundaries, class_balance
from riskweave.session import stored
from riskweave.sources import schema as S


# Below so many rows (k+1 of a vector at most), repeats of a row's own key take places of its neighbours.
FEW_ROWS = 2_000


def positive_weight(train: DataFrame, label: str = S.LABEL) -> float:
    """n0/n1 of the training labels."""
    row = class_balance(train, label).first()
    if not row["n_positive"]:
        raise ValueError("no positive examples in the training rows")
    return row["scale_pos_weight"]


def class_weight_map(weight: float) -> dict[int, float]:
    return {0: 1.0, 1: weight}


def balanced_weights(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """n / (2 n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per class
    return counts.withColumn("weight", total / (F.col("n") * 2))


def weight_column(label: str, weight: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def nearest(df: DataFrame, key: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """Exact k nearest other rows: (key, rank, neighbour, distance, neighbour_row).

    Ties go by key. Features must not be NULL. Rows without a key take no part; rows that repeat a key are
    none of its neighbours, and count one by one for others. Below ``FEW_ROWS`` rows they take places among
    the k+1 nearest, so that a repeated key has fewer than k neighbours. Equal vectors are searched once, and
    against distinct vectors: of equal rows only the k+1 smallest keys can be anyone's neighbour, so a
    mass of copies shrinks to one vector with k+1 keys. The search itself is ``neighbours.nearest_vectors``.
    """
    features = list(features)
    rows = df.select(F.col(key), *[F.col(f).cast("double").alias(f) for f in features])
    missing = any_of([F.col(f).isNull() | F.isnan(f) for f in features])
    if not rows.filter(missing).isEmpty():
        raise ValueError("a missing feature has no distance: impute before the neighbour search")
    rows = rows.filter(F.col(key).isNotNull())
    # Counted first, so that a row repeated very often goes to the window once.
    counted = rows.groupBy(*features, F.col(key).cast("bigint").alias("_nb")).agg(
        F.least(F.count(F.lit(1)), F.lit(k + 1)).cast("int").alias("_times")
    )
    copy = Window.partitionBy(*features).orderBy("_nb")
    keys = counted.withColumn("_copy", F.row_number().over(copy)).filter(F.col("_copy") <= k + 1)
    vectors = stored(
        keys.groupBy(*features).agg(
            F.min("_nb").alias(key),
            F.sort_array(F.collect_list(F.struct("_nb", "_times"))).alias("_keys"),
        )  # at most k+1 entries
    )
    found = nearest_vectors(vectors, key, features, k + 1)
    # The rows behind the vectors, nearest first.
    rows_of = F.flatten(
        F.transform(
            "near",
            lambda v: F.flatten(
                F.transform(
                    v["_keys"],
                    lambda e: F.array_repeat(
                        F.struct(v["d2"].alias("d2"), e["_nb"].alias("nb"), v["row"].alias("row")), e["_times"]
                    ),
                )
            ),
        )
    )
    times = F.array_max(F.transform("near", lambda v: F.array_max(v["_keys"]["_times"])))
    lists = found.select(F.struct(*features).alias("_v"), times.alias("_times"), F.sort_array(rows_of).alias("nbs"))
    copies = F.least(F.aggregate("_keys", F.lit(0), lambda n, e: n + e["_times"]), F.lit(k + 1))
    if (vectors.agg(F.sum(copies)).first()[0] or 0) < FEW_ROWS:
        kept = F.filter("nbs", lambda e: F.coalesce(e <= F.get("nbs", F.lit(k)), F.lit(True)))
    else:  # as many as leave k when a key's own are taken out
        kept = F.slice("nbs", F.lit(1), F.col("_times") + k)
    done = stored(lists.select("_v", kept.alias("nbs")), "lists")

    # Back from vectors to rows; a row drops itself from its vector's list.
    counts = rows.groupBy(F.struct(*features).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    answer = done.join(counts, "_v")
    state = State.of(answer, "_v", "_n")
    listed = lookup_join(rows.withColumn("_v", F.struct(*features)), state, key)
    others = F.filter("nbs", lambda e: e["nb"] != F.col(key))
    return listed.select(key, F.posexplode(F.slice(others, 1, k)).alias("p", "e")).select(
        key,
        (F.col("p") + 1).alias("rank"),
        F.col("e.nb").alias("neighbour"),
        F.sqrt("e.d2").alias("distance"),
        F.col("e.row").alias("neighbour_row"),
    )


def smote(
    train: DataFrame,
    features: Sequence[str],
    ratio: float,
    *,
    train_only: bool,
    k: int = 5,
    seed: int = 42,
    label: str = S.LABEL,
    key: str = S.KEY,
) -> DataFrame:
    """Training rows plus synthetic minority rows until minority/majority = ``ratio``.

    Each synthetic row lies between a minority row and one of its k neighbours; pick
    and position come from digests of (key, copy), so a retry gives the same rows.
    Synthetic rows have a NULL key.
    """
    if train_only is not True:
        raise AssertionError("resample training rows only: pass train_only=True")
    features = list(features)
    balance = class_balance(train, label).first()
    n1 = balance["n_positive"]
    if not n1:
        raise ValueError("no positive examples in the training rows")
    wanted = int(balance["n_negative"] * ratio) - n1
    real = train.select(key, *features, label)
    if wanted <= 0 or n1 < 2:
        return real
    minority = stored(real.filter(F.col(label) == 1).select(key, *features))
    each, extra = divmod(wanted, n1)
    h, md5 = hash60(F.col(key), seed), seeded_md5(F.col(key), seed)
    keyed = minority.select(h.alias("_h"), md5.alias("_md5"))
    (b,) = boundaries(keyed, "_h", "_md5", [extra], n1)
    copies = F.lit(each) + F.when(b.precedes(h, md5), 1).otherwise(0)
    near = min(k, n1 - 1)
    pairs = nearest(minority, key, features, near)
    draw = F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string"))
    picks = (
        minority.withColumn("_copies", copies)
        .filter(F.col("_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("rank", (F.floor(hash_unit(draw, seed) * near) + 1).cast("int"))
        .withColumn("gap", hash_unit(draw, seed + 1))
    )
    made = picks.join(pairs.select(key, "rank", "neighbour_row"), [key, "rank"]).select(
        F.lit(None).cast("bigint").alias(key),
        *[
            (F.col(f) + F.col("gap") * (F.col(f"neighbour_row.{f}") - F.col(f))).alias(f)
            for f in features
        ],
        F.lit(1).alias(label),
    )
    return real.unionByName(made)
