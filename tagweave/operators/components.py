"""Connected components with the smallest member as label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.session import checkpointed


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, materialised, with their fingerprint."""
    saved = checkpointed(edges)
    row = saved.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return saved, (row["n"], row["h"])


def _star_round(edges: DataFrame) -> DataFrame:
    return _small_star(checkpointed(_large_star(edges))).distinct()


# In both steps the minima are written before they are joined: the join then has two plain inputs, and the rows of a node
# with very many neighbours are split over several tasks at run time.
def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node in its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
    joined = both.where("b > a").join(checkpointed(smallest), F.col("a") == F.col("_a"))
    return joined.select(F.col("b").alias("a"), F.col("_m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = checkpointed(down.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a"))
    moved = down.join(smallest, F.col("a") == F.col("_a")).where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(smallest.select(F.col("_a").alias("a"), F.col("_m").alias("b")))


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """(node, label) for every node met in an edge; ``label`` is the smallest node of its component.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce
    and Beyond", 2014). Minima are partially aggregated before the shuffle and written before they are joined, so a node with
    very many neighbours is never one task; the number of rounds grows with the logarithm of the size.
    """
    named = checkpointed(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).distinct())
    nodes = named.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars, seen = _settled(_star_round(named.where("a <> b")))
    while True:
        stars, now = _settled(_star_round(stars))
        if now == seen:
            break
        seen = now
    return nodes.join(stars, nodes["node"] == stars["a"], "left").select("node", F.coalesce("b", "node").alias("label"))


def merge_labels(*labelled: DataFrame) -> DataFrame:
    """One labelling from several (node, label) tables, e.g. one per genome chunk."""
    pairs = reduce(DataFrame.unionByName, [t.select("node", "label") for t in labelled])
    return connected_components(pairs, "node", "label")


def retag(reads: DataFrame, labels: DataFrame, barcode: str = "bx") -> DataFrame:
    """Replace barcodes by their component label; unknown and missing barcodes stay."""
    merges = labels.where("node <> label").select(F.col("node").alias(barcode), F.col("label").alias("_label"))
    columns = reads.columns
    joined = lookup(reads, merges, barcode).withColumn(barcode, F.coalesce("_label", barcode))
    return joined.select(*columns)
