"""Structural variant calls: derived columns and size tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.histograms import SIZE_CLASSES, size_class

# Meaning of breakend orientations and haplotype pairs.
ORIENTATION_TYPES = {"+-": "DEL", "++": "INV", "--": "INV", "-+": "DUP"}
HAPLOTYPE_ZYGOSITY = {"1,1": "HOM", "2,2": "HOM", "1,2": "HET", "2,1": "HET"}
SV_TYPES = ["DEL", "INV", "DUP"]


def _lookup(column: str, meanings: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in meanings.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit("UNK"))


def annotate(calls: DataFrame) -> DataFrame:
    """Add ``length`` (0 between chromosomes), ``svtype`` and ``zygosity``."""
    same = F.col("chr1") == F.col("chr2")
    return calls.withColumns({
        "length": F.when(same, F.abs(F.col("break2") - F.col("break1"))).otherwise(F.lit(0)),
        "svtype": _lookup("orientation", ORIENTATION_TYPES),
        "zygosity": _lookup("haplotype", HAPLOTYPE_ZYGOSITY),
    })


def size_table(calls: DataFrame) -> DataFrame:
    """Passing calls by size class (rows, all present) and type (columns DEL, INV, DUP)."""
    label = F.when(F.col("chr1") != F.col("chr2"), F.lit("Interchrom")).otherwise(size_class(F.col("length")))
    counts = (
        annotate(calls)
        .where("filter = 'PASS'")
        .groupBy(label.alias("Size"))
        .agg(*[F.count_if(F.col("svtype") == t).alias(t) for t in SV_TYPES])
        .where(F.col("Size").isNotNull())
    )
    names = ["Interchrom", *[name for name, _ in SIZE_CLASSES]]
    session = calls.sparkSession
    spine = session.createDataFrame([(i, n) for i, n in enumerate(names)], "ord int, Size string")
    return F.broadcast(spine).join(counts, "Size", "left").fillna(0, SV_TYPES).orderBy("ord").select("Size", *SV_TYPES)


def size_totals(table: DataFrame) -> DataFrame:
    """Total per size class over all types."""
    return table.select("Size", (F.col("DEL") + F.col("INV") + F.col("DUP")).alias("Total"))


def total_calls(table: DataFrame) -> DataFrame:
    """Number of typed calls in a size table."""
    return table.agg(F.sum(F.col("DEL") + F.col("INV") + F.col("DUP")).alias("svs"))
