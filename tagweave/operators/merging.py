"""Merging the results of earlier runs: molecule tables, alignments and variants."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.operators.reads import coordinate_sorted, drop_phasing_tags


def shifted_ids(rows: DataFrame, identifier: str = "MoleculeID", number: str = "FileNr") -> DataFrame:
    """``rows`` with identifiers made unique over files: each file's start after the largest ones of the files before it."""
    most = rows.groupBy(number).agg(F.max(identifier).alias("_most"))
    # One row per file.
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    shifts = most.select(number, F.coalesce(F.sum("_most").over(before), F.lit(0)).alias("_shift"))
    return lookup(rows, shifts, number).withColumn(identifier, F.col(identifier) + F.col("_shift")).drop("_shift")


def merged_alignments(runs: Sequence[DataFrame], contigs: DataFrame | None = None) -> DataFrame:
    """All alignments of several runs in genome order, unmapped ones last, without their phasing tags."""
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)
    return coordinate_sorted(drop_phasing_tags(joined), contigs)


def ordered_variants(parts: Sequence[DataFrame], contigs: DataFrame) -> DataFrame:
    """Variants (``chrom, pos``) of several parts in the order of ``contigs`` (name, nr) and position; unlisted contigs come last.

    The sort is range partitioned on the whole key, so a long chromosome spreads over tasks.
    """
    joined = reduce(DataFrame.unionByName, parts)
    ranked = lookup(joined, contigs.select(F.col("name").alias("chrom"), F.col("nr").alias("_nr")), "chrom")
    return ranked.orderBy(F.col("_nr").asc_nulls_last(), "chrom", "pos").drop("_nr")
