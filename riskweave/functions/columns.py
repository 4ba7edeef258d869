"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per day and hour, raw columns of the engineered features.
DAY = 86400
HOUR = 3600


def r6(c: Column) -> Column:
    """Six digits, halves up, never a negative zero.

    Rounding to nine digits first drops the noise of summation order, so that ties go
    the same way whatever the partitioning was.
    """
    return F.floor(F.round(c, 9) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def ratio(a: Column, b: Column) -> Column:
    """a/b, and 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def time_of_day(dt: Column) -> Column:
    return F.pmod(dt, F.lit(DAY)).cast("int")


def day_of_week(dt: Column) -> Column:
    """Day 0-6 counted from the dataset's own epoch, not a calendar weekday."""
    return F.pmod(F.floor(dt / DAY), F.lit(7)).cast("int")


def hour_of_day(dt: Column) -> Column:
    return F.floor(F.pmod(dt, F.lit(DAY)) / HOUR).cast("int")


def log_amount(amt: Column) -> Column:
    return F.log1p(amt)


def amount_to_age(amt: Column, age: Column) -> Column:
    return F.try_divide(amt, F.coalesce(age, F.lit(0.0)) + F.lit(1.0))


def is_round(amt: Column) -> Column:
    return (F.pmod(amt, F.lit(1.0)) == 0).cast("int")


def clip_upper(c: Column, top: float) -> Column:
    return F.when(c > top, F.lit(float(top))).otherwise(c)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def decide(p: Column, threshold: float) -> Column:
    return (p >= threshold).cast("int")


def risk_band(p: Column) -> Column:
    # Bands at 0.50 and 0.25.
    return F.when(p >= 0.50, "high").when(p >= 0.25, "medium").otherwise("low")


def direction_text(v: Column) -> Column:
    # The two direction texts of a per-row explanation.
    return F.when(v > 0, "increases_fraud_risk").otherwise("decreases_fraud_risk")


def label_text(y: Column) -> Column:
    return F.when(y == 1, "Fraud").otherwise("Legitimate")


def feature_family(name: Column) -> Column:
    """Family by name prefix; the first match in this order wins."""
    # The prefixes, in order.
    out = None
    for prefix in ("V", "C", "D", "M", "id_", "card", "addr"):
        hit = name.startswith(prefix)
        out = F.when(hit, prefix) if out is None else out.when(hit, prefix)
    return out.otherwise("other")


def hash60(key: Column, seed: int) -> Column:
    """Leading 60 bits of md5(key, seed) as a number; sorts as the digest does."""
    return F.conv(F.substring(seeded_md5(key, seed), 1, 15), 16, 10).cast("bigint")


def seeded_md5(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def hash_unit(key: Column, seed: int) -> Column:
    """A repeatable draw from [0, 1) per key: the leading 48 bits of the digest."""
    bits = F.conv(F.substring(seeded_md5(key, seed), 1, 12), 16, 10).cast("double")
    return bits / F.lit(float(1 << 48))


def event_time(dt: Column, epoch_offset: int) -> Column:
    return F.timestamp_seconds(dt + F.lit(epoch_offset))
