"""Coverage and differences of alignments, base by base but without a row per base.

Depth counts aligned bases: deletions and skipped stretches are no coverage, and where the mates of a name overlap they count once. Differences
to the reference are read off the MD text and the CIGAR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.alleles import aligned_blocks, votes
from tagweave.operators.intervals import depth_segments
from tagweave.operators.molecules import permissive_sessions


def fragment_blocks(reads: DataFrame, min_mapq: int = 0) -> DataFrame:
    """(chrom, start, end): positions that a name covers on a chromosome, overlapping and touching stretches of its records joined."""
    blocks = aligned_blocks(reads.where(votes(min_mapq)), ("qname", "rname"))
    joined = permissive_sessions(blocks, ["rname", "qname"], 0)
    whole = joined.groupBy("rname", "qname", "mol_start").agg(F.max("end").alias("end"))
    return whole.select(F.col("rname").alias("chrom"), F.col("mol_start").alias("start"), "end")


def aligned_depth(reads: DataFrame, width: int = 1 << 16, min_mapq: int = 0) -> DataFrame:
    """(chrom, start, end, depth): stretches of constant depth of names over aligned bases, from mapped primary records that are no duplicates."""
    return depth_segments(fragment_blocks(reads, min_mapq), width)


def _operation(kinds: str) -> Column:
    numbers = F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{kinds}]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def differences(md: str = "md") -> dict[str, Column]:
    """Columns of a read: aligned bases, mismatches (from MD), inserted and deleted bases and the number of gaps (from the CIGAR)."""
    replaced = F.regexp_replace(F.regexp_replace(F.upper(md), r"\^[A-Z]+", ""), "[^A-Z]", "")
    return {
        "aligned_bases": _operation("M=X"),
        "mismatches": F.length(replaced).cast("long"),
        "inserted_bases": _operation("I"),
        "deleted_bases": _operation("D"),
        "gaps": F.size(F.regexp_extract_all("cigar", F.lit(r"\d+[ID]"), F.lit(0))).cast("long"),
    }


def difference_rates(reads: DataFrame, md: str = "md", min_mapq: int = 0) -> DataFrame:
    """One row: examined records, aligned bases, mismatches and gaps, and both as shares of aligned bases. Records without MD count no mismatch."""
    rows = reads.where(votes(min_mapq)).select(*[c.alias(n) for n, c in differences(md).items()])
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("aligned_bases", "mismatches", "inserted_bases", "deleted_bases", "gaps")]
    counted = rows.agg(F.count(F.lit(1)).alias("records"), *sums)
    return counted.withColumns({f"{c}_share": F.try_divide(c, "aligned_bases") for c in ("mismatches", "gaps")})
