"""From tagged alignments to filtered molecules, in one lazily built flow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.operators import components, duplicates, molecules
from tagweave.operators.reads import strip_barcodes
from tagweave.operators.statistics import molecule_statistics
from tagweave.session import checkpointed


@dataclass
class LinkedReads:
    """Results of the flow."""

    labels: DataFrame
    reads: DataFrame
    molecules: DataFrame
    statistics: DataFrame


# Bits of an ordering number below the contig's rank: 31 for the start, 12 for the flag.
PLACE_BITS = 43


def contig_ranks(reads: DataFrame, contigs: DataFrame | None = None) -> DataFrame:
    """(rname, rank): contigs in index order when (name, nr) rows are given, else by name."""
    if contigs is not None:
        return contigs.select(F.col("name").alias("rname"), F.col("nr").cast("long").alias("rank"))
    # One row per contig.
    names = reads.where(F.col("rname").isNotNull()).select("rname").distinct()
    return names.withColumn("rank", F.row_number().over(Window.orderBy("rname")).cast("long"))


def read_pairs(reads: DataFrame, min_mapq: int = 0, contigs: DataFrame | None = None) -> DataFrame:
    """Forward / reverse proper pairs as positions: mate start, read end and orientation.

    Records of a name are paired in genome order, contig by contig; mapping checks apply to the first of a pair.
    """
    flag = F.col("flag")
    proper = (flag.bitwiseAND(4) == 0) & (flag.bitwiseAND(8) == 0) & (flag.bitwiseAND(2) != 0) & (F.col("mapq") >= min_mapq)
    mapped = reads.where(F.col("start").isNotNull()).select("qname", "rname", "start", "end", "flag", "mapq", "bx")
    ranked = lookup(mapped, contig_ranks(mapped, contigs), "rname")
    # One ordering number per record: contig, coordinate, then read of the pair; unlisted contigs come last.
    place = F.shiftleft(F.coalesce("rank", F.lit((1 << 20) - 1)), PLACE_BITS) + F.col("start").cast("long") * 4096 + flag % 4096
    numbered = ranked.withColumn("place", place).drop("rank")
    pairs = duplicates.paired_reads(numbered, "place", proper, 1 << PLACE_BITS)
    forward = (F.col("mate_flag").bitwiseAND(16) == 0) & (F.col("read_flag").bitwiseAND(16) != 0)
    first_second = (F.col("mate_flag").bitwiseAND(64) != 0) & (F.col("read_flag").bitwiseAND(128) != 0)
    return pairs.where(forward & (F.col("read_rname") == F.col("mate_rname"))).select(
        F.col("read_rname").alias("rname"),
        F.col("mate_start").alias("start"),
        F.col("read_end").alias("end"),
        F.when(first_second, "F").otherwise("R").alias("orientation"),
        F.col("read_bx").alias("bx"),
    )


def linked_reads(
    reads: DataFrame,
    library_type: str = "dbs",
    window: int = molecules.DEFAULT_WINDOW,
    min_reads: int = molecules.DEFAULT_MIN_READS,
    min_mapq: int = 20,
    quantile: float = 0.99,
    max_molecules: int = 260,
) -> LinkedReads:
    """Merge barcodes of one droplet, build molecules, and drop barcodes with too many of them."""
    pairs = checkpointed(read_pairs(reads, min_mapq))
    edges = duplicates.droplet_links(duplicates.seed_positions(pairs, quantile), library_type, window)
    labels = components.connected_components(edges)
    merged = checkpointed(components.retag(reads, labels))
    built = checkpointed(molecules.build_molecules(merged, library_type, window, min_reads, min_mapq))
    crowded = molecules.crowded_barcodes(built, max_molecules)
    kept = checkpointed(molecules.molecule_table(molecules.without_barcodes(built, crowded)))
    tagged = molecules.tag_reads(merged, library_type, window, min_reads, min_mapq)
    return LinkedReads(labels, strip_barcodes(tagged, crowded), kept, molecule_statistics(kept))
