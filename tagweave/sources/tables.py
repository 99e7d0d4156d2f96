"""Cluster, merge, molecule and barcode tables, and lists of values."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup

MOLECULE_COLUMNS = ["MoleculeID", "Barcode", "Reads", "Length", "BpCovered"]


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Headerless cluster table: canonical, size, comma-joined components."""
    rows = spark.read.schema("canonical string, size bigint, components string").option("sep", "\t").csv(path)
    return rows.withColumn("components", F.split("components", ","))


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """Barcode merges as (node, label)."""
    return spark.read.schema("node string, label string").csv(path)


def _place_of(path: Column, paths: Sequence[str]) -> Column:
    """The place in ``paths`` of the file or folder that a file belongs to."""
    return F.coalesce(*[F.when(path.rlike(f"(^|[/:]){re.escape(str(p).strip('/'))}(/[^/]*)?$"), F.lit(nr)) for nr, p in enumerate(paths)])


def read_molecules(spark: SparkSession, paths: Sequence[str], number: str = "FileNr") -> DataFrame:
    """Molecule tables of several files or folders in one read, numbered by place in ``paths``.

    A file's first line names its columns; files without the molecule columns, and empty ones, are left out.
    """
    fields = spark.read.text([str(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("_path"), F.split("value", "\t").alias("_f")
    )
    wanted = F.array(*[F.lit(c) for c in MOLECULE_COLUMNS])
    is_head = F.size(F.array_intersect("_f", wanted)) == len(MOLECULE_COLUMNS)
    heads = fields.where(is_head).groupBy("_path").agg(F.min("_f").alias("_head"))
    rows = lookup(fields.where(~is_head), heads, "_path").where(F.col("_head").isNotNull())

    def value(name: str) -> Column:
        return F.try_element_at("_f", F.array_position("_head", F.lit(name)).cast("int"))

    return rows.select(
        value("MoleculeID").cast("long").alias("MoleculeID"),
        value("Barcode").alias("Barcode"),
        *[value(c).cast("long").alias(c) for c in MOLECULE_COLUMNS[2:]],
        _place_of(F.col("_path"), paths).alias(number),
    )


def read_words(spark: SparkSession, path: str, name: str = "bx") -> DataFrame:
    """Whitespace-separated words of a file, e.g. a barcode list."""
    words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias(name))
    return words.where(F.col(name) != "").distinct()


def requested_values(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    """(value): the given values, or the lines of a file when one existing path is given."""
    if len(values) == 1 and os.path.isfile(values[0]):
        lines = spark.read.text(values[0]).select(F.trim("value").alias("value"))
        return lines.where("value <> ''").distinct()
    return spark.createDataFrame([(str(v),) for v in values], "value string").distinct()
