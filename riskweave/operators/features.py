"""Leak-free feature engineering: fit small state on training rows, then project.

``fit`` reads training rows only. Medians and the label mean become literals; group
medians and category statistics become keyed state tables. ``transform`` is one
projection over lookup joins and changes no row count.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.operators.lookup import State, lookup_join, row_bytes
from riskweave.operators.order import grouped_quantiles, quantile_values
from riskweave.session import running_session, stored
from riskweave.sources import schema as S


class NotFitted(RuntimeError):
    pass


def column_medians(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict:
    """Median per column; a column without values gets 0."""
    if approx:
        row = df.agg(*[F.percentile_approx(c, 0.5, 10_000).alias(c) for c in columns]).first()
        return {c: float(row[c]) if row[c] is not None else 0.0 for c in columns}
    found = quantile_values(df, columns, [0.5])
    return {c: found[c, 0.5] if found[c, 0.5] is not None else 0.0 for c in columns}


def group_medians(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per key: the median of each raw column, and the rows behind it. NULL keys drop out."""
    rows = df.filter(F.col(key).isNotNull())
    q = grouped_quantiles(rows, [key], columns, [0.5])
    return q.groupBy(key).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"{c}_med") for c in columns],
        F.max("n").alias("n"),
    )


def category_stats(df: DataFrame, columns: Sequence[str], label: str = S.LABEL) -> DataFrame:
    """(column, category, label_sum, n) of all columns in one pass. NULLs drop out."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in columns]
    )
    return (
        df.select(F.col(label).cast("double").alias("_y"), F.inline(entries))
        .filter(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.sum("_y").alias("label_sum"), F.count(F.lit(1)).alias("n"))
    )


def category_states(df: DataFrame, columns: Sequence[str], label: str = S.LABEL) -> dict:
    """Category statistics as one lookup state per column: (c, c_sum, c_n)."""
    table = stored(category_stats(df, columns, label), "categories")
    # What a row of the state of a column has: category, sum, rows, and rows once more as its weight.
    size = row_bytes(table.select("category", "label_sum", "n")) + F.lit(8)
    sizes = dict(table.groupBy("column").agg(F.sum(size)).collect())
    out = {}
    for c in columns:
        one = table.filter(F.col("column") == c).select(
            F.col("category").alias(c),
            F.col("label_sum").alias(f"{c}_sum"),
            F.col("n").alias(f"{c}_n"),
            F.col("n").alias("_w"),
        )
        out[c] = State(one, c, sizes.get(c, 0), "_w")
    return out


def loo_mean(total: Column, n: Column, y: Column, overall: Column) -> Column:
    """Mean of the other rows of the category; the overall mean for a lone or unseen one."""
    return F.when(n > 1, (total - y) / (n - 1)).otherwise(overall)


def smoothed_mean(total: Column, n: Column, overall: Column, smoothing: float) -> Column:
    """Category mean shrunk towards the overall mean; unseen categories get the latter."""
    w = n / (n + F.lit(smoothing))
    return F.when(n > 0, w * (total / n) + (F.lit(1.0) - w) * overall).otherwise(overall)


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Fill NULLs with literals, all columns in one projection."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double") if types[c] != "bigint" else F.col(c),
                       F.lit(medians[c]).cast(types[c] if types[c] == "bigint" else "double"))
            .alias(c)
            if c in medians
            else F.col(c)
            for c in df.columns
        ]
    )


def missing_indicators(
    df: DataFrame, train: DataFrame, columns: Sequence[str], low: float, high: float
) -> DataFrame:
    """``<c>_was_missing`` for columns whose training null share is in (low, high]."""
    shares = train.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    chosen = [c for c in columns if low < (shares[c] or 0.0) <= high]
    return df.select(
        "*", *[F.col(c).isNull().cast("int").alias(f"{c}_was_missing") for c in chosen]
    )


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's features in its order; a missing one becomes NULL."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[F.col(f) if f in have else F.lit(None).cast("double").alias(f) for f in features],
    )


@dataclass
class FeatureEngineer:
    norm_cols: Sequence[str] = tuple(S.NORM_COLS)
    norm_group: str = S.NORM_GROUP
    encoded: Sequence[str] = tuple(S.ENCODED)
    smoothing: float = S.SMOOTHING
    label: str = S.LABEL
    key: str = S.KEY

    medians: dict[str, float] = field(default_factory=dict)
    overall: float = 0.0
    groups: State | None = None
    categories: dict[str, State] = field(default_factory=dict)
    fitted: bool = False

    def fit(self, train: DataFrame) -> FeatureEngineer:
        schema = train.schema
        imputed = S.present(schema, [*S.IMPUTED, *S.V_COLS])
        self.medians = column_medians(train, imputed) if imputed else {}
        norm = S.present(schema, list(self.norm_cols))
        if norm and self.norm_group in schema.names:
            table = group_medians(train, self.norm_group, norm)
            renamed = table.withColumnRenamed(self.norm_group, "_group")
            self.groups = State.of(renamed, "_group", "n")
        encoded = S.present(schema, list(self.encoded))
        if encoded:
            self.overall = train.agg(F.avg(self.label)).first()[0] or 0.0
            self.categories = category_states(train, encoded, self.label)
        self.fitted = True
        return self

    def transform(self, df: DataFrame, train_rows: Column | None = None) -> DataFrame:
        """All features. ``train_rows`` marks the rows that were fitted on: they get
        leave-one-out encodings, all others smoothed ones."""
        if not self.fitted:
            raise NotFitted("call fit before transform")
        names = set(df.columns)
        out = impute(df, {c: m for c, m in self.medians.items() if c in names})
        dt, amt = F.col(S.TIME), F.col("TransactionAmt")
        new: dict[str, Column] = {
            "time_of_day": C.time_of_day(dt),
            "day_of_week": C.day_of_week(dt),
            "hour_of_day": C.hour_of_day(dt),
            "log_transaction_amt": C.log_amount(amt),
            "amt_to_d1_ratio": F.coalesce(
                C.amount_to_age(amt, F.col("D1") if "D1" in names else F.lit(0.0)), F.lit(0.0)
            ),
            "is_round_amt": C.is_round(amt),
        }
        spread = self.key if self.key in names else S.TIME
        if self.groups is not None and self.norm_group in names:
            out = out.withColumn("_group", F.col(self.norm_group))
            out = lookup_join(out, self.groups, spread)
            for c in self.norm_cols:
                if c in names and f"{c}_med" in out.columns:
                    new[f"{c}_card_norm"] = F.coalesce(F.col(c) - F.col(f"{c}_med"), F.lit(0.0))
        overall = F.lit(self.overall)
        for c, state in self.categories.items():
            if c not in names:
                continue
            out = lookup_join(out, state, spread)
            total = F.coalesce(f"{c}_sum", F.lit(0.0))
            n = F.coalesce(f"{c}_n", F.lit(0)).cast("double")
            te = smoothed_mean(total, n, overall, self.smoothing)
            if train_rows is not None:
                y = F.col(self.label).cast("double")
                te = F.when(train_rows, loo_mean(total, n, y, overall)).otherwise(te)
            new[f"{c}_te"] = te
        kept = [c for c in df.columns if c not in self.categories]
        return out.select(*kept, *[e.alias(n) for n, e in new.items()])

    def fit_transform(self, train: DataFrame) -> DataFrame:
        return self.fit(train).transform(train, train_rows=F.lit(True))

    # --- persisted state ---------------------------------------------------------

    def save(self, path: str) -> None:
        """State tables as Parquet, parameters as one JSON row, under one path."""
        if not self.fitted:
            raise NotFitted("call fit before save")
        params = {
            "norm_cols": list(self.norm_cols), "norm_group": self.norm_group,
            "encoded": list(self.encoded), "smoothing": self.smoothing, "label": self.label,
            "key": self.key, "medians": self.medians, "overall": self.overall,
            "has_groups": self.groups is not None, "categories": list(self.categories),
        }
        if self.groups is not None:
            self.groups.table.write.mode("overwrite").parquet(f"{path}/groups")
        for c, s in self.categories.items():
            s.table.write.mode("overwrite").parquet(f"{path}/category_{c}")
        spark = running_session()
        spark.createDataFrame([(json.dumps(params),)], "value string").write.mode(
            "overwrite"
        ).text(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureEngineer:
        p = json.loads(spark.read.text(f"{path}/params").first()[0])
        out = cls(p["norm_cols"], p["norm_group"], p["encoded"], p["smoothing"], p["label"],
                  p.get("key", S.KEY), p["medians"], p.get("overall", 0.0))

        def state(name: str, key: str, weight: str) -> State:
            return State.read(spark.read.parquet(f"{path}/{name}"), key, weight)

        if p.get("has_groups"):
            out.groups = state("groups", "_group", "n")
        for c in p["categories"]:
            out.categories[c] = state(f"category_{c}", c, "_w")
        out.fitted = True
        return out


def without_encoding(**kw) -> FeatureEngineer:
    """The default pipeline's engineer: raw, time, amount and normalised features."""
    return FeatureEngineer(encoded=(), **kw)


def feature_columns(df: DataFrame, label: str = S.LABEL) -> list[str]:
    """The numeric columns a model may see: no key, no label."""
    return [c for c in S.numeric_columns(df.schema) if c not in (*S.EXCLUDED, label, "split")]


def encoding_audit(df: DataFrame, column: str, label: str = S.LABEL, top: int = 5) -> DataFrame:
    """Encoded value against the actual rate of the rows that carry it, largest gaps."""
    te = C.r6(F.col(column))
    out = df.groupBy(te.alias("te")).agg(
        F.avg(label).alias("actual_rate"), F.count(F.lit(1)).alias("n")
    )
    gap = C.r6(F.abs(F.col("te") - F.col("actual_rate")))
    return out.withColumn("gap", gap).orderBy(F.col("gap").desc(), "te").limit(top)


def range_check(
    df: DataFrame, columns: Sequence[str], train: Column, slack: float = 1e-4
) -> DataFrame:
    """Per column: do the other rows stay within the training range, give or take?"""
    aggs = []
    for c in columns:
        for side, rows in (("train", train), ("test", ~train)):
            v = F.when(rows, F.col(c))
            aggs += [F.min(v).alias(f"{c}_{side}_min"), F.max(v).alias(f"{c}_{side}_max")]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{c}_{s}").alias(s) for s in ("train_min", "train_max", "test_min", "test_max")],
            (
                (F.col(f"{c}_test_min") >= F.col(f"{c}_train_min") - slack)
                & (F.col(f"{c}_test_max") <= F.col(f"{c}_train_max") + slack)
            ).alias("in_range"),
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def time_feature_range(df: DataFrame) -> DataFrame:
    return df.agg(
        *[
            f(c).alias(f"{c}_{n}")
            for c in ("time_of_day", "day_of_week", "hour_of_day")
            for n, f in (("min", F.min), ("max", F.max))
        ]
    )
