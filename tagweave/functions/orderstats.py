"""Exact order statistics: N50 family, weighted Nx curves, auN and interpolated quantiles.

All of them rank *distinct values* after a partial aggregation, through the two-level scan, so
no group is sorted in one task and nothing is approximated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.scans import BUCKET, ordered_scan, running_sum, total_sum

# Buckets of values that are cut by rank.
RANK_PARTS = 256


def ranked_totals(
    df: DataFrame,
    value: str,
    weight: Column,
    keys: Sequence[str] = (),
    descending: bool = True,
    width: float | None = 1 << 16,
) -> DataFrame:
    """One row per (keys, value): its ``weight`` sum, the running ``upto`` and the key ``total``.

    Without a ``width`` (for fractional values, which may be arbitrarily dense) buckets are cut by rank: at approximate quantiles of the
    distinct values, so that each holds about one part in :data:`RANK_PARTS` of them.
    """
    totals = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("weight"))
    ordered = totals.withColumn("_order", -F.col(value) if descending else F.col(value))
    if width is None:
        marks = [i / RANK_PARTS for i in range(1, RANK_PARTS)]
        cuts = ordered.agg(F.percentile_approx("_order", marks, 4 * RANK_PARTS)).scalar()
        below = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_order"))), F.lit(0))
        ordered, width = ordered.withColumn("_cuts", cuts).withColumn(BUCKET, below.cast("long")).drop("_cuts"), 1
    return ordered_scan(
        ordered,
        keys,
        "_order",
        width,
        upto=running_sum(F.col("weight")),
        total=total_sum(F.col("weight")),
    ).drop("_order")


def n50_inclusive(df: DataFrame, length: str, keys: Sequence[str] = (), width: float = 1 << 16) -> DataFrame:
    """Longest-first: the length at which the running sum first reaches half the total."""
    ranked = ranked_totals(df, length, F.col(length), keys, width=width)
    return ranked.groupBy(*keys).agg(
        F.max(F.when(F.col("upto") >= F.floor(F.col("total") / 2), F.col(length))).alias("n50")
    )


def nx(
    df: DataFrame,
    span: str,
    x: int = 50,
    keys: Sequence[str] = (),
    weight: str | None = None,
    total: Column | None = None,
    width: float | None = 1 << 16,
) -> DataFrame:
    """Strict Nx: first span, longest first, whose running weight *exceeds* x % of the total.

    ``weight`` defaults to the span itself (Nx / NGx); a count column gives ANx. ``total`` replaces
    the internal total, e.g. the reference length for NGx. NULL when never exceeded.
    """
    ranked = ranked_totals(df, span, F.col(weight or span), keys, width=width)
    target = (F.col("total") if total is None else total) * F.lit(x)
    return ranked.groupBy(*keys).agg(F.max(F.when(F.col("upto") * 100 > target, F.col(span))).alias("nx"))


def nx_curve(
    df: DataFrame,
    span: str,
    keys: Sequence[str] = (),
    weight: str | None = None,
    total: Column | None = None,
    width: float | None = 1 << 16,
) -> DataFrame:
    """Nx for x = 0..100; thresholds that are never exceeded give 0.

    Each ranked span answers the contiguous integer x between its running sums, so the curve
    comes from one ranking and at most 101 emitted rows per key.
    """
    ranked = ranked_totals(df, span, F.col(weight or span), keys, width=width)
    goal = F.col("total") if total is None else total
    upto, prior = F.col("upto") * 100, (F.col("upto") - F.col("weight")) * 100
    low = F.when(goal > 0, F.ceil(prior / goal)).otherwise(F.lit(0)).cast("int")
    high = F.when(goal > 0, F.ceil(upto / goal) - 1).otherwise(F.lit(100)).cast("int")
    answered = (
        ranked.select(*keys, span, low.alias("_low"), F.least(high, F.lit(100)).alias("_high"))
        .where("_low <= _high")
        .select(*keys, span, F.explode(F.sequence("_low", "_high")).alias("x"))
        .groupBy(*keys, "x")
        .agg(F.max(span).alias("y"))
    )
    spine = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    spine = spine.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(100))).alias("x"))
    return spine.join(answered, [*keys, "x"], "left").select(*keys, "x", F.coalesce("y", F.lit(0)).alias("y"))


def area_under_nx(span: str, total: Column | None = None) -> Column:
    """auN as an aggregate expression: sum of squared spans over the total (NULL when that is 0)."""
    squares = F.sum((F.col(span) * F.col(span)).cast("decimal(38,0)")).cast("double")
    return F.try_divide(squares, F.sum(span) if total is None else total)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    keys: Sequence[str] = (),
    width: float = 1 << 16,
) -> DataFrame:
    """Linearly interpolated quantiles, one output column per entry of ``quantiles``."""
    ranked = ranked_totals(df, value, F.lit(1), keys, descending=False, width=width)
    first, beyond = F.col("upto") - F.col("weight"), F.col("upto")
    picks, results = [], []
    for name, q in quantiles.items():
        height = (F.col("total") - 1) * F.lit(float(q))
        for side, rank in (("lo", F.floor(height)), ("hi", F.ceil(height))):
            inside = (first <= rank) & (rank < beyond)
            picks.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{side}"))
        picks.append(F.max(height - F.floor(height)).alias(f"_{name}_f"))
        results.append(
            (F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_f")).alias(name)
        )
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)
