"""Barcode counting, correction, mapping onto reads, numbering and binning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions import dna
from tagweave.functions.scans import ordered_scan, row_index, running_sum
from tagweave.functions.skew import lookup
from tagweave.operators.editlinks import cluster_members
from tagweave.session import checkpointed

# Read mappers and how they want barcodes: sorted by barcode, or only named in the header.
SORTED_MAPPERS = ("ema", "lariat")


def count_barcodes(reads: DataFrame, barcode: str = "barcode") -> DataFrame:
    """(barcode, n); Spark counts within map tasks first, so a dominating barcode costs nothing."""
    return reads.where(F.col(barcode).isNotNull()).groupBy(F.col(barcode).alias("barcode")).agg(
        F.count(F.lit(1)).alias("n")
    )


def wanted_barcodes(reads: DataFrame, barcode: str = "barcode", shortest: int = 19, longest: int = 21) -> DataFrame:
    """Extracted barcodes of acceptable length without unread bases."""
    return reads.where(F.length(barcode).between(shortest, longest) & ~F.col(barcode).contains("N"))


def hamming_neighbours(queries: DataFrame, targets: DataFrame, query: str, target: str) -> DataFrame:
    """(query, target) pairs at Hamming distance 1, for targets differing by a proper base.

    Both sides are expanded to their masked forms (one per position) and joined on those: linear in
    the input, and the pairs of one mask are at most the four bases.
    """
    left = queries.select(F.col(query).alias("_query"), F.inline(dna.masks(F.col(query)))).withColumnRenamed("base", "_b")
    right = targets.select(F.col(target).alias("_target"), F.inline(dna.masks(F.col(target))))
    return (
        left.join(right, ["pos", "mask"])
        .where((F.col("base") != F.col("_b")) & F.col("base").isin(*"ACGT"))
        .select("_query", "_target")
    )


def correct_singles(counts: DataFrame) -> DataFrame:
    """Cluster table (canonical, size, components) from barcode counts.

    A barcode seen once joins the only repeated barcode one substitution away; with none or several
    it stays alone.
    """
    singles = counts.where("n = 1").select("barcode")
    multiples = counts.where("n > 1")
    absorbed = (
        hamming_neighbours(singles, multiples, "barcode", "barcode")
        .groupBy("_query")
        .agg(F.count(F.lit(1)).alias("_k"), F.min("_target").alias("canonical"))
        .where("_k = 1")
        .select(F.col("_query").alias("barcode"), "canonical")
    )
    # At most 3 x length singles can lie one substitution away from a barcode.
    extras = absorbed.groupBy("canonical").agg(F.sort_array(F.collect_list("barcode")).alias("_extra"))
    grown = (
        multiples.join(extras, multiples["barcode"] == extras["canonical"], "left")
        .select(
            F.col("barcode").alias("canonical"),
            (F.col("n") + F.coalesce(F.size("_extra"), F.lit(0))).alias("size"),
            F.concat(F.array("barcode"), F.coalesce("_extra", F.array().cast("array<string>"))).alias("components"),
        )
    )
    alone = singles.join(absorbed, "barcode", "left_anti").select(
        F.col("barcode").alias("canonical"), F.lit(1).cast("long").alias("size"), F.array("barcode").alias("components")
    )
    return grown.unionByName(alone)


def match_whitelist(counts: DataFrame, whitelist: DataFrame, hamming: bool = False) -> DataFrame:
    """(barcode, n, corrected): in the whitelist as is, or its only whitelist neighbour, else NULL."""
    known = whitelist.select("barcode").distinct()
    exact = counts.join(known.select("barcode", F.col("barcode").alias("_hit")), "barcode", "left")
    if not hamming:
        return exact.withColumnRenamed("_hit", "corrected")
    missed = exact.where("_hit IS NULL").select("barcode")
    near = (
        hamming_neighbours(missed, known, "barcode", "barcode")
        .groupBy(F.col("_query").alias("barcode"))
        .agg(F.count(F.lit(1)).alias("_k"), F.min("_target").alias("_near"))
        .where("_k = 1")
        .drop("_k")
    )
    return exact.join(near, "barcode", "left").select("barcode", "n", F.coalesce("_hit", "_near").alias("corrected"))


def cluster_by_messages(counts: DataFrame, max_dist: int = 2, ratio: int = 5) -> DataFrame:
    """Cluster table by message passing on edit distance, the members of a cluster as one list, as cluster files have them.

    A barcode hands its reads to the neighbour that is at least ``ratio`` times as frequent, nearest first, then most frequent, then smallest;
    chains end at their root. ``editlinks.cluster_members`` gives members by row.
    """
    members = cluster_members(counts, max_dist, ratio)
    return members.groupBy("canonical").agg(F.max("size").alias("size"), F.sort_array(F.collect_list("barcode")).alias("components"))


def passing_clusters(clusters: DataFrame, min_count: int = 0, template: str | None = None) -> DataFrame:
    """Clusters large enough and, where a template is given, of the right composition."""
    keep = F.col("size") >= min_count
    if template:
        keep = keep & dna.matches_template(F.col("canonical"), template)
    return clusters.where(keep)


def barcode_map(clusters: DataFrame) -> DataFrame:
    """(raw_barcode, barcode): every component with its canonical sequence."""
    return clusters.select(F.explode("components").alias("raw_barcode"), F.col("canonical").alias("barcode"))


def attach_barcodes(reads: DataFrame, raw_barcodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Reads (``name`` up to its first space is the key) with raw and canonical barcode, if any.

    ``raw_barcodes`` holds (read_name, raw_barcode). The raw barcode is corrected before the reads
    are touched, so the wide read table is shuffled once.
    """
    corrected = lookup(raw_barcodes, barcode_map(clusters), "raw_barcode").select(
        F.substring_index("read_name", " ", 1).alias("_key"), "raw_barcode", "barcode"
    )
    keyed = reads.withColumn("_key", F.substring_index("name", " ", 1))
    return keyed.join(corrected, "_key", "left").drop("_key")


def tagged_name(mapper: str, barcode_tag: str = "BX", sequence_tag: str = "RX") -> Column:
    """Header with barcode information in the form the mapper reads (unchanged without barcode)."""
    head, rest = F.substring_index("name", " ", 1), F.regexp_extract("name", r"^\S+\s+(.*)$", 1)
    corrected = F.concat(F.lit(f"{barcode_tag}:Z:"), F.col("barcode"))
    if mapper == "ema":
        tagged = F.concat(head, F.lit(":"), F.col("barcode"), F.lit(" "), corrected)
    elif mapper == "lariat":
        tagged = F.col("name")
    else:
        raw = F.concat(F.lit(f"{sequence_tag}:Z:"), F.col("raw_barcode"))
        tagged = F.concat(head, F.lit("_"), raw, F.lit("_"), corrected, F.lit(" "), rest)
    return F.when(F.col("barcode").isNotNull(), tagged).otherwise(F.col("name"))


def first_seen(rows: DataFrame, key: str, order: str, width: int) -> DataFrame:
    """(key, rank): distinct values numbered from 1 in order of first appearance.

    ``order`` is an integer, unique per row; distinct keys therefore first appear at distinct places.
    """
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    return ordered_scan(first, [], "_first", width, rank=row_index()).select(key, "rank")


def generated_barcodes(rows: DataFrame, index: str, order: str, width: int) -> DataFrame:
    """(index, barcode): a generated 16-base barcode per distinct index, by first appearance."""
    return first_seen(rows, index, order, width).select(index, dna.generated_barcode(F.col("rank")).alias("barcode"))


def parse_indexed_names(rows: DataFrame, name: str = "name") -> DataFrame:
    """Split ``name#a_b_c/1`` (text after a tab is dropped) into ``read_name`` and ``index``.

    The index is NULL when unread (0_0_0) or incomplete. Only the suffix ``/1`` is removed.
    """
    bare = F.regexp_replace(F.substring_index(F.col(name), "\t", 1), "/1$", "")
    index = F.substring_index(bare, "#", -1)
    valid = (index != "0_0_0") & (F.size(F.split(index, "_")) >= 3)
    return rows.withColumn("read_name", F.substring_index(bare, "#", 1)).withColumn("index", F.when(valid, index))


def heap_order(clusters: DataFrame, prefix: int = 16, buckets: int = 3) -> DataFrame:
    """(canonical, heap): barcodes in an order where neighbours do not share their first bases.

    The k-th barcodes of all prefixes form layer k. Within a layer prefixes are distinct, those with
    most barcodes first, so the border of two layers repeats a prefix only when one is left.
    """
    head = F.substring("canonical", 1, prefix)
    named = clusters.select("canonical", head.alias("_head"), F.md5(head).alias("_spot"))
    # A prefix has at most 4 ** (length - prefix) barcodes.
    group = Window.partitionBy("_head")
    layered = named.withColumn("_layer", F.row_number().over(group.orderBy("canonical"))).withColumn(
        "_size", F.count(F.lit(1)).over(group)
    )
    slot = ["_layer", "_rest", "_slot"]
    placed = layered.withColumn("_rest", -F.col("_size")).withColumn("_slot", F.substring("_spot", 1, buckets))
    sizes = placed.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n"))
    # One row per layer, then the slots of a layer: a window never holds all of them.
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    layers = sizes.groupBy("_layer").agg(F.sum("_n").alias("_n")).select(
        "_layer", F.coalesce(F.sum("_n").over(earlier.orderBy("_layer")), F.lit(0)).alias("_base")
    )
    inside = F.coalesce(F.sum("_n").over(earlier.partitionBy("_layer").orderBy("_rest", "_slot")), F.lit(0))
    offsets = sizes.withColumn("_inside", inside).join(layers, "_layer").select(*slot, (F.col("_base") + F.col("_inside")).alias("_offset"))
    within = Window.partitionBy(*slot).orderBy("_spot")
    return placed.join(offsets, slot).select(
        "canonical", (F.col("_offset") + F.row_number().over(within) - 1).alias("heap")
    )


def pack_bins(heaps: DataFrame, nr_bins: int, width: int = 4096) -> DataFrame:
    """(heap, n) -> ``bin``: rows in heap order fill bins of total // nr_bins, heaps stay whole.

    A bin counts as full after every (size + 1)-th row overall, and the next bin opens at the first
    heap that begins after such a row; so a heap's bin is the dense rank of the number of fills
    before it. That number is below nr_bins + 1, so ranking it is tiny.
    """
    total = heaps.agg(F.sum("n")).scalar()
    scanned = ordered_scan(heaps, [], "heap", width, _upto=running_sum(F.col("n")))
    step = F.floor(total / F.lit(nr_bins)) + 1
    filled = scanned.select("heap", "n", F.floor((F.col("_upto") - F.col("n")) / step).alias("_fills"))
    ranks = filled.select("_fills").distinct().select(
        "_fills", (F.row_number().over(Window.orderBy("_fills")) - 1).alias("bin")
    )
    return filled.join(ranks, "_fills").select("heap", "n", "bin")


def round_robin_bins(rows: DataFrame, barcode: str, order: str, nr_bins: int, width: int) -> DataFrame:
    """(barcode, bin): each new barcode takes the next bin in turn and keeps it."""
    ranked = first_seen(rows, barcode, order, width)
    return ranked.select(barcode, F.pmod(F.col("rank") - 1, F.lit(nr_bins)).cast("int").alias("bin"))
