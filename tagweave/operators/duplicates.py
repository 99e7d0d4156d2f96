"""Barcodes from one droplet: barcodes that share two nearby duplicate positions.

A *position* is a read pair's (mate start, read end, orientation) on a chromosome. Two barcodes are
linked when two different positions carry both and lie an acceptable distance apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.orderstats import exact_quantiles
from tagweave.functions.scans import ordered_scan, previous, prior_max, row_index
from tagweave.functions.skew import lookup
from tagweave.operators.molecules import TOLERATED_OVERLAP, permissive_sessions
from tagweave.session import checkpointed

POSITION = ["rname", "start", "end", "orientation"]


def paired_reads(reads: DataFrame, order: str, qualifies, width: int, name: str = "qname") -> DataFrame:
    """(mate, read) rows: consecutive records of a name, the first of which qualifies.

    A record that meets a waiting mate completes the pair whatever its own quality; one that meets
    none waits if it qualifies. Hence a record waits iff it stands at an odd place in its run of
    qualifying records, and the next record of the name is its partner.
    """
    columns = [c for c in reads.columns if c not in (name, order)]
    indexed = checkpointed(
        ordered_scan(
            reads.withColumn("_q", qualifies),
            [name],
            order,
            width,
            _i=row_index(),
            _mate=previous(F.struct(order, *columns, "_q")),
        )
    )
    # Index of the last non-qualifying record before this one: the mate's run starts after it, and
    # the mate is part of a run only when it qualifies itself.
    runs = ordered_scan(indexed, [name], order, width, _stop=prior_max(F.when(~F.col("_q"), F.col("_i"))))
    mate_place = F.col("_i") - 1 - F.coalesce("_stop", F.lit(0))
    waiting = F.coalesce(F.col("_mate._q"), F.lit(False)) & (mate_place % 2 == 1)
    return runs.where(waiting).select(
        name,
        F.col(order).alias(f"read_{order}"),
        *[F.col(c).alias(f"read_{c}") for c in columns],
        F.col(f"_mate.{order}").alias(f"mate_{order}"),
        *[F.col(f"_mate.{c}").alias(f"mate_{c}") for c in columns],
    )


def _barcode_rows(pairs: DataFrame, barcode: str) -> DataFrame:
    return pairs.where(F.col(barcode).isNotNull()).select(*POSITION, F.col(barcode).alias("bx")).distinct()


def _shared_positions(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*POSITION).agg(F.count(F.lit(1)).alias("barcodes")).where("barcodes > 1")


def duplicate_positions(pairs: DataFrame, barcode: str = "bx") -> DataFrame:
    """Positions with more than one barcode and their number of distinct barcodes."""
    return _shared_positions(_barcode_rows(pairs, barcode))


def coverage_threshold(positions: DataFrame, quantile: float = 0.99, minimum: int = 6) -> DataFrame:
    """Per chromosome: max(minimum, ceil(quantile of barcodes per duplicate position))."""
    got = exact_quantiles(positions, "barcodes", {"q": quantile}, ["rname"])
    return got.select("rname", F.greatest(F.lit(minimum), F.ceil("q")).cast("long").alias("threshold"))


def seed_positions(pairs: DataFrame, quantile: float = 0.99, minimum: int = 6, barcode: str = "bx") -> DataFrame:
    """(position, barcode) rows of duplicate positions below the coverage threshold."""
    # Pairs are read and reduced once.
    rows = checkpointed(_barcode_rows(pairs, barcode))
    positions = checkpointed(_shared_positions(rows))
    limits = coverage_threshold(positions, quantile, minimum)
    kept = checkpointed(positions.join(limits, "rname").where("barcodes < threshold").select(*POSITION))
    found = lookup(rows, kept.withColumn("_kept", F.lit(True)), POSITION)
    return found.where(F.col("_kept")).drop("_kept")


def shared_pairs(seeds: DataFrame) -> DataFrame:
    """(position, a, b) with a < b for barcodes met at one position.

    Barcodes seen at a single position of a chromosome cannot form an edge and are dropped first;
    the coverage threshold bounds what is left of a position.
    """
    seeds = checkpointed(seeds)
    repeated = seeds.groupBy("rname", "bx").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = (
        seeds.join(repeated, ["rname", "bx"], "left_semi")
        .groupBy(*POSITION)
        .agg(F.sort_array(F.collect_set("bx")).alias("bcs"))
        .where(F.size("bcs") > 1)
    )
    first = members.select(*POSITION, "bcs", F.posexplode("bcs").alias("i", "a"))
    later = F.slice("bcs", F.col("i") + 2, F.greatest(F.size("bcs") - F.col("i") - 1, F.lit(0)))
    return first.select(*POSITION, "a", F.explode(later).alias("b"))


def barcode_edges(seeds: DataFrame, library_type: str = "dbs", window: int = 30000) -> DataFrame:
    """Distinct (src, dst) barcode links, all pairs of a position being compared.

    Positions have start < end. A link needs positions q before p with p.start - q.end in [0, window] or equal to a tolerated overlap.
    """
    return _linked(checkpointed(shared_pairs(seeds)), library_type, window)


def _linked(pairs: DataFrame, library_type: str, window: int) -> DataFrame:
    """(src, dst) of barcode pairs that meet at two positions an acceptable distance apart.

    Only existence matters, so q is looked up through the smallest and largest end of each
    window-wide bucket instead of being joined to p pair by pair: every step is a partial aggregate.
    """
    keys = ["rname", "a", "b"]
    band = TOLERATED_OVERLAP[library_type]
    if band is None:
        sessions = permissive_sessions(pairs, keys, window)
        linked = sessions.groupBy(*keys, "mol_start").agg(F.sum("reads").alias("n")).where("n > 1")
        return linked.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    # Ends of one slot differ by at most window, so any end <= start in the start's own slot is near.
    width = window + 1
    ends = pairs.groupBy(*keys, F.floor(F.col("end") / width).alias("slot")).agg(
        F.min("end").alias("lo"), F.max("end").alias("hi")
    )
    starts = pairs.select(*keys, "start").distinct()
    here = F.floor(F.col("start") / width)
    near = (
        starts.withColumn("slot", F.explode(F.array(here, here - 1)))
        .join(ends, [*keys, "slot"])
        .where(
            F.when(F.col("slot") == here, F.col("lo") <= F.col("start")).otherwise(F.col("hi") >= F.col("start") - window)
        )
        .select("a", "b")
    )
    low, high = band
    place = F.struct("start", "end", "orientation")
    firsts = pairs.groupBy(*keys, "end").agg(F.min(place).alias("first"))
    lasts = pairs.groupBy(*keys, "start").agg(F.max(place).alias("last"))
    overlapping = (
        lasts.withColumn("end", F.explode(F.sequence(F.col("start") + low, F.col("start") + high)))
        .join(firsts, [*keys, "end"])
        .where("first < last")
        .select("a", "b")
    )
    return near.unionByName(overlapping).distinct().select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _reach(rows: DataFrame, library_type: str, window: int) -> tuple[DataFrame, DataFrame, str]:
    """Slots in which a position waits for later ones, slots in which it looks for earlier ones, and what holds of a pair (q, p)."""
    band, width = TOLERATED_OVERLAP[library_type], window + 1
    slot = lambda place: F.floor(place / width)
    start, end = F.col("at.start"), F.col("at.end")
    if band is None:
        waits = rows.withColumn("slot", F.explode(F.sequence(slot(start), slot(end + window))))
        return waits, rows.withColumn("slot", slot(start)), f"q < p AND p.start - q.end <= {window}"
    # Slots of tolerated overlaps are single ends, numbered below zero.
    low, high = band
    waits = rows.withColumn("slot", F.explode(F.array(slot(end), -1 - end)))
    overlaps = F.transform(F.sequence(F.lit(low), F.lit(high)), lambda n: -1 - start - n)
    looks = rows.withColumn("slot", F.explode(F.concat(F.array(slot(start), slot(start) - 1), overlaps)))
    near = f"slot >= 0 AND p.start - q.end BETWEEN 0 AND {window}"
    return waits, looks, f"({near}) OR (slot < 0 AND q < p)"


def droplet_links(seeds: DataFrame, library_type: str = "dbs", window: int = 30000, crowd: int = 8) -> DataFrame:
    """(src, dst) links with the components of :func:`barcode_edges`, linear in positions, whatever a barcode's share of them.

    A barcode with at most ``crowd`` positions in reach of each other is looked up at pairs of its positions; all such barcodes of one pair are
    tied to the smallest. A *crowded* barcode is not: it is paired with the other barcodes of its positions, a row each, and a link is
    read off the ends met in each slot. Starts are 0 or more.
    """
    rows = checkpointed(seeds.select("rname", "bx", F.struct("start", "end", "orientation").alias("at")))
    waits, _, _ = _reach(rows, library_type, window)
    crowded = waits.groupBy("rname", "bx", "slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
    marked = checkpointed(lookup(rows, crowded.select("rname", "bx").distinct().withColumn("_crowded", F.lit(True)), ["rname", "bx"]))
    waits, looks, holds = _reach(marked.where("_crowded IS NULL").drop("_crowded"), library_type, window)
    met = checkpointed(
        looks.withColumnRenamed("at", "p")
        .join(waits.withColumnRenamed("at", "q"), ["rname", "bx", "slot"])
        .where(holds)
        .select("rname", "q", "p", "bx")
    )
    groups = met.groupBy("rname", "q", "p").agg(F.min("bx").alias("src"), F.max("bx").alias("_most")).where("src < _most")
    held = checkpointed(groups.drop("_most"))
    few = met.join(held, ["rname", "q", "p"]).where("bx > src").select("src", F.col("bx").alias("dst"))
    many = marked.where("_crowded").select("rname", "at", F.col("bx").alias("_h"))
    if many.isEmpty():
        return few.distinct()
    # Two crowded barcodes find each other from either side; one side is enough.
    paired = many.join(marked, ["rname", "at"]).where("_h <> bx AND (_crowded IS NULL OR _h < bx)")
    pairs = checkpointed(paired.select("rname", "at.*", F.least("_h", "bx").alias("a"), F.greatest("_h", "bx").alias("b")))
    return few.unionByName(_linked(pairs, library_type, window)).distinct()


def mark_duplicates(reads: DataFrame, keys: Sequence[str], quality: str, name: str) -> DataFrame:
    """Add ``is_duplicate``: all but the best read (quality, then smallest name) of each key.

    The best read is found by a partial aggregate; reads then look it up.
    """
    keys = list(keys)
    best = F.min(F.struct((-F.col(quality)).alias("q"), F.col(name).alias("name")))
    keep = checkpointed(reads.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best.name").alias("_keep")))
    return lookup(reads, keep, keys).withColumn("is_duplicate", F.col(name) != F.col("_keep")).drop("_keep")
