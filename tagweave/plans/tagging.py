"""Barcoding read pairs: clusters to reads, barcode order and bins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.operators import barcodes as bc
from tagweave.session import checkpointed


@dataclass
class TaggedPairs:
    """Pairs with barcode, in barcode order where the mapper needs it, and pairs without."""

    barcoded: DataFrame
    other: DataFrame


def tag_pairs(
    pairs: DataFrame,
    raw_barcodes: DataFrame,
    clusters: DataFrame,
    mapper: str = "bowtie2",
    min_count: int = 0,
    template: str | None = None,
    nr_bins: int = 100,
    barcode_tag: str = "BX",
    sequence_tag: str = "RX",
) -> TaggedPairs:
    """Correct, name and (for barcode-sorting mappers) order and bin read pairs.

    General mappers keep pairs without barcode among the others; sorting mappers set them apart.
    """
    kept = checkpointed(bc.passing_clusters(clusters, min_count, template))
    joined = bc.attach_barcodes(pairs, raw_barcodes, kept)
    name = bc.tagged_name(mapper, barcode_tag, sequence_tag)
    second = name if mapper == "ema" else F.col("name2")
    if mapper not in (*bc.SORTED_MAPPERS,):
        rest = F.regexp_extract("name2", r"^\S+\s+(.*)$", 1)
        head = F.regexp_extract(name, r"^(\S+)", 1)
        second = F.when(F.col("barcode").isNotNull(), F.concat(head, F.lit(" "), rest)).otherwise(F.col("name2"))
    tagged = joined.withColumns({"name2": second, "name": name})
    if mapper not in bc.SORTED_MAPPERS:
        return TaggedPairs(tagged, tagged.where("false"))
    heaps = bc.heap_order(kept) if mapper == "ema" else bc.heap_order(kept, prefix=64)
    return packed(checkpointed(tagged), heaps, nr_bins)


def packed(tagged: DataFrame, heaps: DataFrame, nr_bins: int) -> TaggedPairs:
    """Barcoded pairs with their heap and bin, of (canonical, heap) rows; bins hold about equal numbers of pairs."""
    counts = checkpointed(bc.count_barcodes(tagged.where("barcode IS NOT NULL")).join(heaps.withColumnRenamed("canonical", "barcode"), "barcode"))
    bins = bc.pack_bins(counts.select("heap", "n"), nr_bins)
    places = counts.select("barcode", "heap").join(bins.select("heap", "bin"), "heap")
    return TaggedPairs(lookup(tagged.where("barcode IS NOT NULL"), places, "barcode"), tagged.where("barcode IS NULL"))
