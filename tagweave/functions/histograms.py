"""Histogram binning with the edge rules each report uses; bins are labelled by their lower edge."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.session import checkpointed

# Size classes of structural variants and their upper bounds in bp.
SIZE_CLASSES = [
    ("0-1k", 1_000),
    ("1k-10k", 10_000),
    ("10k-100k", 100_000),
    ("100k-1M", 1_000_000),
    ("1M-10M", 10_000_000),
    ("10M-100M", 100_000_000),
    ("100M-1G", 1_000_000_000),
]


def ratio_percent_bin(part: Column, whole: Column) -> Column:
    """Percent bin of part / whole over right-closed bins (0, .01] .. (.99, 1]; NULL outside.

    Integer arithmetic, so ratios on an edge never depend on floating point.
    """
    step = F.when((part > 0) & (part <= whole), F.ceil(part * 100 / whole).cast("int"))
    exact = F.when(F.pmod(part * 100, whole) == 0, (part * 100 / whole).cast("int"))
    return F.coalesce(F.when(step.isNotNull(), exact), step) - 1


def right_closed_bin(value: Column, width: int) -> Column:
    """Lower edge of (a, a + width]; NULL for values of 0 or less."""
    return F.when(value > 0, (F.ceil(value / F.lit(width)) - 1) * F.lit(width))


def left_closed_bin(value: Column, width: int) -> Column:
    """Lower edge of [a, a + width)."""
    return F.floor(value / F.lit(width)) * F.lit(width)


def size_class(length: Column) -> Column:
    """Decade size class; classes are closed on the left, the last one on both sides."""
    label = F.when(length < SIZE_CLASSES[0][1], F.lit(SIZE_CLASSES[0][0]))
    for name, upper in SIZE_CLASSES[1:-1]:
        label = label.when(length < upper, F.lit(name))
    last, upper = SIZE_CLASSES[-1]
    return label.when(length <= upper, F.lit(last))


def weighted_length_histogram(df: DataFrame, length: str, width: int = 1000) -> DataFrame:
    """Bases in molecules per right-closed length bin; empty bins are left out."""
    return (
        df.groupBy(right_closed_bin(F.col(length), width).alias("Bin"))
        .agg(F.sum(length).alias("LengthSum"))
        .where(F.col("Bin").isNotNull() & (F.col("LengthSum") > 0))
    )


def coverage_histogram(df: DataFrame, covered: str, length: str) -> DataFrame:
    """Molecules per percent of bases covered."""
    return (
        df.groupBy(ratio_percent_bin(F.col(covered), F.col(length)).alias("Percent"))
        .agg(F.count(F.lit(1)).alias("Count"))
        .where(F.col("Percent").isNotNull())
    )


def count_histogram(df: DataFrame, value: str, width: int = 2, drop_even_maximum: bool = False) -> DataFrame:
    """Rows per left-closed bin. ``drop_even_maximum`` repeats the original script's edge: bins that
    end exactly at the maximum leave that maximum out."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    if drop_even_maximum:
        top = df.agg(F.max(value)).scalar()
        counts = counts.where((F.col(value) % width != 0) | (F.col(value) != top))
    return counts.groupBy(left_closed_bin(F.col(value), width).alias("Bin")).agg(F.sum("_rows").alias("Count"))


def bin_sums(df: DataFrame, value: str, width: int = 2000, normalize: bool = False) -> DataFrame:
    """Sum of values per left-closed bin, empty bins from the lowest (0 at most) to the highest included."""
    sums = checkpointed(df.groupBy(left_closed_bin(F.col(value), width).alias("Bin")).agg(F.sum(value).alias("_sum")))
    edges = sums.agg(F.min("Bin").alias("low"), F.max("Bin").alias("top"), F.sum("_sum").alias("total")).first()
    if edges["top"] is None:
        return sums.select("Bin", F.col("_sum").alias("Weight"))
    spine = df.sparkSession.range(min(0, edges["low"]), edges["top"] + 1, width).select(F.col("id").alias("Bin"))
    full = spine.join(sums, "Bin", "left").withColumn("_sum", F.coalesce("_sum", F.lit(0)))
    weight = F.try_divide(F.col("_sum"), F.lit(edges["total"])) if normalize else F.col("_sum")
    return full.select("Bin", weight.alias("Weight"))


def geometric_edges(longest: int, step: int = 10_000, count: int = 100) -> list[int]:
    """Geometrically spaced edges rounded down to ``step``; equal edges are kept."""
    return [int(e) for e in (np.geomspace(step, longest + step, num=count) // step) * step]


def geometric_length_histogram(df: DataFrame, length: str, keys: Sequence[str] = (), step: int = 10_000) -> DataFrame:
    """Length-weighted, normalised histogram over geometric bins shared by all ``keys``.

    Labels are thousands of bp. Lengths under the first edge are outside the plot.
    """
    longest = df.agg(F.max(length)).first()[0]
    edges = geometric_edges(longest, step)
    labels = sorted(set(edges[:-1]))
    bounds = F.array(*[F.lit(e) for e in sorted(set(edges))])
    binned = (
        df.where(F.col(length) >= edges[0])
        .groupBy(*keys, F.array_max(F.filter(bounds, lambda e: e <= F.col(length))).alias("_edge"))
        .agg(F.sum(length).alias("_sum"))
    )
    totals = binned.groupBy(*keys).agg(F.sum("_sum").alias("_total"))
    spine = totals.select(*keys, "_total", F.explode(F.array(*[F.lit(e) for e in labels])).alias("_edge"))
    return spine.join(binned, [*keys, "_edge"], "left").select(
        *keys,
        (F.col("_edge") / 1000).cast("int").alias("kbp"),
        F.round(F.coalesce(F.col("_sum") / F.col("_total"), F.lit(0.0)), 6).alias("density"),
    )
