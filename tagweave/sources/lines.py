"""Text files as numbered lines, numbered in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.functions.scans import ordered_scan, running_max

LINE_WIDTH = 1 << 16


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, line_no, line), ``line_no`` from 0 within each file.

    Large files are read in splits; lines are numbered inside their split and shifted by the line
    counts of the splits before it (one row per split, as the scan's own list on the driver), so lines are never
    the side that is broadcast: the size of compressed files says little about them.
    """
    # The id column is nondeterministic to the optimizer, so nothing is filtered below it.
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    splits = lines.groupBy("path", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select(
        "path", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    return lines.join(F.broadcast(shifts), ["path", "_split"]).select(
        "path", (F.col("_shift") + F.col("_id") - F.col("_first")).alias("line_no"), "line"
    )


def grouped_lines(lines: DataFrame, size: int, names: Sequence[str]) -> DataFrame:
    """Every ``size`` consecutive lines of a file as one row (path, record, names...)."""
    record, place = F.floor(F.col("line_no") / size), F.col("line_no") % size
    return lines.groupBy("path", record.alias("record")).agg(
        *[F.max(F.when(place == i, F.col("line"))).alias(name) for i, name in enumerate(names)]
    )


def carried_section(lines: DataFrame, is_header, name, default: str, keys: Sequence[str] = ("path",)) -> DataFrame:
    """Add ``section``: the name on the last header line at or before each line."""
    marked = F.when(is_header, F.struct(F.col("line_no").alias("_at"), name.alias("_name")))
    scanned = ordered_scan(lines, keys, "line_no", LINE_WIDTH, _section=running_max(marked))
    return scanned.withColumn("section", F.coalesce("_section._name", F.lit(default))).drop("_section")


def split_fields(lines: DataFrame, trim: bool = False) -> DataFrame:
    """One column ``f``: the tab-separated fields of each line.

    The one-element explode keeps the optimizer from copying the split into every later use of it.
    """
    text = F.trim("line") if trim else F.col("line")
    return lines.select(F.explode(F.array(F.split(text, "\t"))).alias("f"))
