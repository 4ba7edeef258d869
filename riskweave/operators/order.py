"""Exact order work without one-task sorts: running totals, ranks, quantiles.

Three building blocks, all exact whatever the distribution:

* ``running_totals`` cuts an ordering into value ranges, totals each range, and
  adds those offsets to window sums that run inside a range only.
* ``quantile_table`` and ``values_at_ranks`` narrow a bracket around the wanted
  rank with sketches, and shuffle only the values left inside the bracket.
* ``grouped_quantiles`` does the same per key with value ranges as cells, so a
  key that holds most rows is spread over all ranges.

Cut points come from a sketch; they decide balance only, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import any_of

# Sketch sizes: a rank error near 0.2 % for brackets, finer for cut points.
BRACKET_K, EDGES_K = 2000, 4096
BRACKET_MARGIN = 0.005
SKETCH_SLOTS = 256
# Rows strictly inside a bracket that one task may rank, and rows in all brackets together; the same
# at every table size. Each narrowing saved is two passes over the table.
CANDIDATE_LIMIT, CANDIDATES = 1 << 17, 1 << 22
# Rounds after which a bracket that no sketch narrows is ranked as it is.
MOST_ROUNDS = 12
# Rows in a value range, about, and the most ranges that a sketch can tell apart.
RANGE_ROWS, MOST_RANGES = 1 << 21, 1 << 14


def range_count(rows: int) -> int:
    """Ranges to cut an ordering into, from the counted rows."""
    return max(16, min(MOST_RANGES, rows // RANGE_ROWS))


def sketch_quantiles(
    df: DataFrame, wants: Sequence[tuple[Column, Sequence[float]]], k: int
) -> list[list[float] | None]:
    """Approximate quantiles of each column, None without values.

    Task sketches are merged in two steps, ``SKETCH_SLOTS`` at a time and then the
    slots, so no task has to merge the sketches of a hundred thousand others.
    """
    names = [f"s{i}" for i in range(len(wants))]
    slot = F.pmod(F.spark_partition_id(), F.lit(SKETCH_SLOTS)).alias("slot")
    values = [c.cast("double").alias(n) for n, (c, _) in zip(names, wants)]
    slots = df.select(slot, *values).groupBy("slot").agg(
        *[F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in names]
    )
    whole = slots.agg(*[F.kll_merge_agg_double(n, F.lit(k)).alias(n) for n in names])
    row = whole.select(
        *[
            F.when(
                F.kll_sketch_get_n_double(n) > 0,
                F.kll_sketch_get_quantile_double(n, F.array(*[F.lit(float(p)) for p in probs])),
            ).alias(n)
            for n, (_, probs) in zip(names, wants)
        ]
    ).first()
    return list(row)


def range_edges(df: DataFrame, columns: Sequence[str], n: int | None = None) -> dict[str, list[float]]:
    """At most ``n - 1`` inner cut points per column; the only data the driver sees."""
    n = n or range_count(df.count())
    probs = [i / n for i in range(1, n)]
    k = max(EDGES_K, min(65_535, 4 * n))
    found = sketch_quantiles(df, [(F.col(c), probs) for c in columns], k)
    return {c: sorted(set(q or [])) for c, q in zip(columns, found)}


def with_ranges(df: DataFrame, edges: dict[str, list[float]], prefix: str = "_range_") -> DataFrame:
    """Add ``_range_<column>``: the index of the value range each value falls in."""
    inf = float("inf")
    names = [c for c in edges if edges[c]]
    df = df.select("*", *[F.lit(0).alias(f"{prefix}{c}") for c in edges if not edges[c]])
    if not names:
        return df
    cut = Bucketizer(
        splitsArray=[[-inf, *edges[c], inf] for c in names],
        inputCols=[f"_d_{c}" for c in names],
        outputCols=[f"{prefix}{c}" for c in names],
        handleInvalid="keep",
    )
    wide = df.select("*", *[F.col(c).cast("double").alias(f"_d_{c}") for c in names])
    indexed = cut.transform(wide).drop(*[f"_d_{c}" for c in names])
    return indexed.withColumns(
        {f"{prefix}{c}": F.coalesce(F.col(f"{prefix}{c}").cast("int"), F.lit(-1)) for c in names}
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    edges: list[float] | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` along ``order`` within ``keys``.

    Rows must be unique on ``keys`` + ``order`` (aggregate first). Adds ``cum_<c>``
    and ``total_<c>``. No task sorts more than one value range of one key.
    """
    keys = list(keys)
    if edges is None:
        edges = range_edges(df, [order])[order]
    cut = with_ranges(df, {order: edges}).withColumnRenamed(f"_range_{order}", "_range")

    along = F.col("_range").desc() if descending else F.col("_range")
    all_of_key = Window.partitionBy(*keys)
    earlier = all_of_key.orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_range")
        .agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
        .select(
            *keys,
            "_range",
            *[F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
            *[F.sum(f"_s_{c}").over(all_of_key).alias(f"total_{c}") for c in sums],
        )
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per range: MOST_RANGES at most

    by = F.col(order).desc() if descending else F.col(order)
    inside = Window.partitionBy(*keys, "_range").orderBy(by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        cut.join(offsets, [*keys, "_range"])
        .withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.sum(c).over(inside) for c in sums})
        .drop("_range", *[f"_o_{c}" for c in sums])
    )


# --- ranks over a whole column -------------------------------------------------


@dataclass
class Pick:
    """Neighbouring ranks wanted from one column, and the bracket that holds them.

    ``below`` rows lie before the bracket, ``at_low`` and ``at_high`` rows on its bounds,
    ``open`` rows strictly between them. A bound that holds no wanted rank is left out.
    """

    column: str
    ranks: tuple[int, ...]
    open: int
    below: int = 0
    at_low: int = 0
    at_high: int = 0
    low: float | int | None = None
    high: float | int | None = None
    margin: float = BRACKET_MARGIN
    settled: bool = False
    rounds: int = 0

    def between(self) -> Column:
        c = F.col(self.column)
        ok = c.isNotNull()
        if self.low is not None:
            ok = ok & (c > F.lit(self.low))
        if self.high is not None:
            ok = ok & (c < F.lit(self.high))
        return ok

    def contains(self) -> Column:
        c = F.col(self.column)
        ok = c.isNotNull()
        if self.low is not None:
            ok = ok & ((c >= F.lit(self.low)) if self.at_low else (c > F.lit(self.low)))
        if self.high is not None:
            ok = ok & ((c <= F.lit(self.high)) if self.at_high else (c < F.lit(self.high)))
        return ok

    def span(self) -> tuple[float, float]:
        """The wanted ranks as shares of the rows between the bounds, with the margin."""
        start = self.below + self.at_low
        first, last = min(self.ranks) - start, max(self.ranks) - start
        return first / self.open - self.margin, last / self.open + self.margin

    def shrink(self, low, high, counts) -> None:
        """Take a confirmed bracket over; ``counts``: rows below, at low, between, at high."""
        below, at_low, between, at_high = counts
        first, last = min(self.ranks), max(self.ranks)
        before = self.open
        self.low, self.high, self.below = low, high, below
        self.at_low, self.open, self.at_high = at_low, between, at_high
        if last < below + at_low:
            self.high, self.open, self.at_high = low, 0, at_low  # the low bound is the value
        elif first >= below + at_low + between:
            self.low, self.below = high, below + at_low + between
            self.at_low, self.open = at_high, 0
        else:
            if first >= below + at_low:
                self.below, self.at_low = below + at_low, 0
            if last < self.below + self.at_low + between:
                self.at_high = 0
        # Doubles cannot tell values apart any more: what is left is a few hundred of them. A margin
        # widened to the whole bracket says that of few rows only; of many, another sketch is tried.
        self.rounds += 1
        few = self.margin == BRACKET_MARGIN or self.open <= CANDIDATE_LIMIT or self.rounds > MOST_ROUNDS
        self.settled = self.open >= before and few


INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def _narrow(df: DataFrame, picks: list[Pick], limit: int) -> None:
    """Shrink every bracket until at most ``limit`` rows lie strictly inside it.

    A sketch of the rows between the bounds proposes new bounds, an exact count confirms
    that the wanted ranks lie between them; a wrong proposal is widened. A heavy value ends up
    as a bound: it is the answer, or it is left out, or it is one distinct value.
    """
    limit = min(limit, CANDIDATES // max(len(picks), 1))
    while True:
        wide = [p for p in picks if p.open > limit and not p.settled]
        if not wide:
            return
        spans = [p.span() for p in wide]
        found = sketch_quantiles(
            df,
            [
                (F.when(p.between(), F.col(p.column)), [min(1.0, max(0.0, a)), max(0.0, min(1.0, b))])
                for p, (a, b) in zip(wide, spans)
            ],
            BRACKET_K,
        )
        tries = []
        for p, (a, b), (low, high) in zip(wide, spans, found):
            if isinstance(df.schema[p.column].dataType, INTEGRAL):
                low, high = math.floor(low), math.ceil(high)
            tries.append((p.low if a <= 0 else low, p.high if b >= 1 else high))
        counts = df.agg(
            *[
                e.alias(f"{n}{i}")
                for i, (p, (low, high)) in enumerate(zip(wide, tries))
                for n, e in _parts(F.col(p.column), low, high).items()
            ]
        ).first()
        for i, (p, (low, high)) in enumerate(zip(wide, tries)):
            got = counts[4 * i : 4 * i + 4]
            if got[0] > min(p.ranks) or sum(got) <= max(p.ranks):
                p.margin *= 4
                continue
            p.shrink(low, high, got)
            p.margin = BRACKET_MARGIN


def _parts(c: Column, low, high) -> dict[str, Column]:
    """Counts of rows below ``low``, at it, between, and at ``high`` (None is no bound)."""
    none = F.lit(0).cast("bigint")
    over = c.isNotNull() if low is None else c > F.lit(low)
    under = F.lit(True) if high is None else c < F.lit(high)
    same = low is not None and low == high
    return {
        "b": none if low is None else F.count_if(c < F.lit(low)),
        "l": none if low is None else F.count_if(c == F.lit(low)),
        "o": F.count_if(over & under),
        "h": none if high is None or same else F.count_if(c == F.lit(high)),
    }


def _ranked_candidates(df: DataFrame, picks: list[Pick]) -> DataFrame:
    """(pick, lo, hi, value, first, last): the rank span of each distinct value in a
    bracket, next to the lowest and highest rank wanted there."""
    types = {df.schema[p.column].dataType for p in picks}
    same = len(types) == 1
    entries = [
        F.when(
            p.contains(),
            F.struct(
                F.lit(i).alias("pick"),
                (F.col(p.column) if same else F.col(p.column).cast("double")).alias("value"),
                F.lit(p.below).cast("bigint").alias("below"),
                F.lit(min(p.ranks)).cast("bigint").alias("lo"),
                F.lit(max(p.ranks)).cast("bigint").alias("hi"),
            ),
        )
        for i, p in enumerate(picks)
    ]
    upto = Window.partitionBy("pick").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    if len(picks) <= 8 and all(p.low is not None or p.high is not None for p in picks):
        df = df.filter(any_of([p.contains() for p in picks]))  # reaches the Parquet scan
    return (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.pick", "e.below", "e.lo", "e.hi", "e.value")
        .agg(F.count(F.lit(1)).alias("w"))
        .withColumn("last", F.col("below") + F.sum("w").over(upto) - 1)
        .withColumn("first", F.col("last") - F.col("w") + 1)
    )


def literal_table(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A table of a few hundred literal rows, without a Python stage."""
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def quantile_table(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], limit: int | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles: (column, prob, n, value).

    All columns together: one count, a few rounds of sketch and count that narrow brackets
    around the wanted ranks, and one pass that ranks the distinct values left in them.
    """
    limit = CANDIDATE_LIMIT if limit is None else limit
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    picks, meta = [], []
    for c, n in zip(columns, counts):
        for p in probs:
            at = p * (n - 1) if n else 0.0
            lo, hi = math.floor(at), math.ceil(at)
            meta.append((len(picks) if n else -1, c, float(p), n, at - lo))
            if n:
                picks.append(Pick(c, (lo, hi), n))
    _narrow(df, picks, limit)
    wanted = literal_table(df.sparkSession, ["pick", "column", "prob", "n", "frac"], meta)
    wanted = wanted.withColumn("n", F.col("n").cast("bigint"))
    if not picks:
        return wanted.select("column", "prob", "n", F.lit(None).cast("double").alias("value"))
    hit = F.col("value").cast("double")
    found = (
        _ranked_candidates(df, picks)
        .groupBy("pick")
        .agg(
            F.max(F.when(F.col("lo").between(F.col("first"), F.col("last")), hit)).alias("a"),
            F.max(F.when(F.col("hi").between(F.col("first"), F.col("last")), hit)).alias("b"),
        )
    )
    interpolated = F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")
    return wanted.join(F.broadcast(found), "pick", "left").select(  # columns x probs rows
        "column", "prob", "n", interpolated.alias("value")
    )


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """The table above as a dictionary: one number per column and probability."""
    rows = quantile_table(df, columns, probs).collect()
    return {(r["column"], r["prob"]): r["value"] for r in rows}


def values_at_ranks(
    df: DataFrame, column: str, ranks: Sequence[int], n: int, limit: int | None = None
) -> list[tuple]:
    """For each 0-based rank: (value, rows below the value, rows at the value)."""
    picks = [Pick(column, (r,), n) for r in ranks]
    _narrow(df, picks, CANDIDATE_LIMIT if limit is None else limit)
    rows = (
        _ranked_candidates(df, picks)
        .filter(F.col("lo").between(F.col("first"), F.col("last")))
        .select("pick", "value", "first", "w")
        .collect()
    )
    by_pick = {r["pick"]: (r["value"], r["first"], r["w"]) for r in rows}
    return [by_pick[i] for i in range(len(ranks))]


# --- quantiles per key -----------------------------------------------------------


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probs: Sequence[float],
    n_ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles per key: (keys..., column, prob, n, value).

    NULL values are ignored, NULL keys drop out.

    Equal values are counted before the shuffle and each column is cut into value
    ranges, so a hot key becomes many cells; only the cell that holds the wanted
    rank is ordered.
    """
    keys, columns = list(keys), list(columns)
    edges = range_edges(df, columns, n_ranges)
    rows = df.select(*keys, *columns)
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    cut = with_ranges(rows, edges)
    values = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("double").alias("value"),
                F.col(f"_range_{c}").alias("cell"),
            )
            for c in columns
        ]
    )
    counted = (
        cut.select(*keys, F.explode(values).alias("e"))
        .filter(F.col("e.value").isNotNull())
        .groupBy(*keys, "e.column", "e.cell", "e.value")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    group = [*keys, "column"]
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("prob") * (F.col("n") - 1)
    targets = (
        counted.groupBy(*group, "cell")
        .agg(F.sum("w").alias("cw"))
        .withColumns(
            {
                "n": F.sum("cw").over(whole),
                "before": F.coalesce(F.sum("cw").over(earlier), F.lit(0)),
            }
        )
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumns({"lo": F.floor(at), "hi": F.ceil(at), "frac": at - F.floor(at)})
        .filter(
            F.col("lo").between(F.col("before"), F.col("before") + F.col("cw") - 1)
            | F.col("hi").between(F.col("before"), F.col("before") + F.col("cw") - 1)
        )
    )
    in_cell = (
        Window.partitionBy(*group, "cell")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("upto", F.sum("w").over(in_cell))
    last = F.col("before") + F.col("upto") - 1
    first = last - F.col("w") + 1
    return (
        ranked.join(targets, [*group, "cell"])
        .groupBy(*group, "prob", "n", "frac")
        .agg(
            F.max(F.when(F.col("lo").between(first, last), F.col("value"))).alias("_a"),
            F.max(F.when(F.col("hi").between(first, last), F.col("value"))).alias("_b"),
        )
        .select(
            *group,
            "prob",
            "n",
            (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("frac")).alias("value"),
        )
    )
