"""Ordered scans that stay balanced when one key holds a large share of the rows.

A plain window over ``partitionBy(key).orderBy(pos)`` sends a whole key to one task. The scan here
works on two levels instead: each key is cut into position buckets, a window runs inside every
(key, bucket), one summary row per bucket is scanned across buckets, and the carried value is
joined back. Callers pre-aggregate to one row per (key, pos), so a (key, bucket) group holds at
most ``width`` distinct integer positions and a key has at most ``range / width`` summary rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


@dataclass(frozen=True)
class Scan:
    """One scan output; ``kind`` names how bucket-local and carried values combine."""

    kind: str
    expr: Column | None = None


def row_index() -> Scan:
    """1-based position of the row within its key."""
    return Scan("row_index")


def running_sum(expr: Column) -> Scan:
    """Sum over the rows up to and including this one."""
    return Scan("running_sum", expr)


def total_sum(expr: Column) -> Scan:
    """Sum over all rows of the key."""
    return Scan("total_sum", expr)


def total_min(expr: Column) -> Scan:
    """Minimum over all rows of the key."""
    return Scan("total_min", expr)


def running_max(expr: Column) -> Scan:
    """Maximum over the rows up to and including this one."""
    return Scan("running_max", expr)


def prior_max(expr: Column) -> Scan:
    """Maximum over the rows strictly before this one (NULL for the first)."""
    return Scan("prior_max", expr)


def previous(expr: Column) -> Scan:
    """Value on the preceding row (NULL for the first)."""
    return Scan("previous", expr)


def following(expr: Column) -> Scan:
    """Value on the next row (NULL for the last)."""
    return Scan("following", expr)


def _summary_columns(name: str, scan: Scan, order: Column) -> list[Column]:
    if scan.kind == "row_index":
        return [F.count(F.lit(1)).alias(f"_s_{name}")]
    if scan.kind in ("running_sum", "total_sum"):
        return [F.sum(scan.expr).alias(f"_s_{name}")]
    if scan.kind == "total_min":
        return [F.min(scan.expr).alias(f"_s_{name}")]
    if scan.kind in ("running_max", "prior_max"):
        return [F.max(scan.expr).alias(f"_s_{name}")]
    if scan.kind == "previous":
        return [F.max_by(F.struct(scan.expr.alias("v")), order).alias(f"_s_{name}")]
    if scan.kind == "following":
        return [F.min_by(F.struct(scan.expr.alias("v")), order).alias(f"_s_{name}")]
    raise ValueError(scan.kind)


def _carry_column(name: str, scan: Scan, across: Window) -> Column:
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(f"_s_{name}")
    if scan.kind in ("row_index", "running_sum"):
        column = F.coalesce(F.sum(value).over(before), F.lit(0))
    elif scan.kind == "total_sum":
        column = F.sum(value).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    elif scan.kind == "total_min":
        column = F.min(value).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    elif scan.kind in ("running_max", "prior_max"):
        column = F.max(value).over(before)
    elif scan.kind == "previous":
        column = F.lag(value).over(across)
    else:
        column = F.lead(value).over(across)
    return column.alias(f"_c_{name}")


def _local_column(name: str, scan: Scan, within: Window) -> Column:
    carried = F.col(f"_c_{name}")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    if scan.kind == "row_index":
        return F.row_number().over(within) + carried
    if scan.kind == "running_sum":
        return F.sum(scan.expr).over(upto) + carried
    if scan.kind in ("total_sum", "total_min"):
        return carried
    if scan.kind == "running_max":
        return F.greatest(F.max(scan.expr).over(upto), carried)
    if scan.kind == "prior_max":
        return F.greatest(F.max(scan.expr).over(before), carried)
    boxed = F.struct(scan.expr.alias("v"))
    step = F.lag(boxed).over(within) if scan.kind == "previous" else F.lead(boxed).over(within)
    return F.coalesce(step, carried)["v"]


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    width: float = 1 << 16,
    keep_bucket: bool = False,
    **outputs: Scan,
) -> DataFrame:
    """Add running values per non-NULL ``keys`` in ascending ``order`` without gathering a key in one task.

    ``order`` is numeric and unique within the keys; ``width`` is the bucket size in its units. A
    bucket column left by an earlier scan (``keep_bucket``) is used again, which spares a shuffle.
    """
    keys = list(keys)
    rows = df if BUCKET in df.columns else df.withColumn(BUCKET, F.floor(F.col(order) / F.lit(width)).cast("long"))
    group = [*keys, BUCKET]
    summary = rows.groupBy(*group).agg(
        *[column for name, scan in outputs.items() for column in _summary_columns(name, scan, F.col(order))]
    )
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    carried = summary.select(*group, *[_carry_column(name, scan, across) for name, scan in outputs.items()])
    within = Window.partitionBy(*group).orderBy(order)
    joined = rows.join(carried, group)
    kept = [c for c in df.columns if c != BUCKET] + ([BUCKET] if keep_bucket else [])
    return joined.select(*kept, *[_local_column(name, scan, within).alias(name) for name, scan in outputs.items()])


def dense_ids(df: DataFrame, key: Sequence[str], name: str, buckets: int = 1 << 12) -> DataFrame:
    """Number rows 1..n by hash bucket of their unique ``key``: dense, repeatable and balanced."""
    rows = df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)))
    offsets = (
        rows.groupBy(BUCKET)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            BUCKET,
            F.coalesce(
                F.sum("_n").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    within = Window.partitionBy(BUCKET).orderBy(*key)
    return (
        rows.join(offsets, BUCKET)
        .withColumn(name, F.row_number().over(within) + F.col("_offset"))
        .drop(BUCKET, "_offset")
    )
