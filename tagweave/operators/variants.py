"""Variant filters, soft filters, variant numbering and phase blocks.

Variants carry ``chrom, pos`` (0-based start)``, ref, alts`` (array), ``gt`` (array of two allele
numbers), ``phased, ps`` (phase set), ``qual, filter`` (array of names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.orderstats import exact_quantiles
from tagweave.functions.scans import BUCKET
from tagweave.functions.skew import lookup
from tagweave.operators.intervals import overlap_join
from tagweave.session import checkpointed

INDEX_WIDTH = 1 << 20
NO_PHASE_SET = -1


def index_variants(variants: DataFrame) -> DataFrame:
    """Add ``idx``: 1-based record number per chromosome by position, before any filter."""
    rows = variants.where("chrom IS NOT NULL AND pos IS NOT NULL").withColumn(BUCKET, F.floor(F.col("pos") / F.lit(INDEX_WIDTH)))
    counts = rows.groupBy("chrom", BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("chrom").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("chrom", BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # Records are moved once; those sharing a position are the few alternative descriptions of one site.
    place = F.row_number().over(Window.partitionBy("chrom", BUCKET).orderBy("pos", "ref", "alts"))
    return rows.join(offsets, ["chrom", BUCKET]).withColumn("idx", F.col("_before") + place).drop("_before", BUCKET)


def alleles() -> Column:
    """Reference and alternative alleles as one array."""
    return F.concat(F.array("ref"), "alts")


def heterozygous(indels: bool = False) -> Column:
    """Diploid, heterozygous, at most three alleles; single-base alleles unless ``indels``."""
    g0, g1 = F.element_at("gt", 1), F.element_at("gt", 2)
    called = (
        (F.size("gt") == 2)
        & (F.size("alts") <= 2)
        & g0.isin(0, 1, 2)
        & g1.isin(0, 1, 2)
        & (g0 != g1)
    )
    if indels:
        return called
    single = F.forall("gt", lambda g: F.length(F.try_element_at(alleles(), g + 1)) == 1)
    return F.when(called, single).otherwise(F.lit(False))


def is_snv() -> Column:
    """All alleles one base long."""
    return F.forall(alleles(), lambda a: F.length(a) == 1)


def parse_soft_filters(text: str) -> list[tuple[str, str]]:
    """``condition,name;condition,name`` as (condition, name) pairs; quotes and blanks are dropped."""
    pairs = []
    for item in text.replace("'", "").split(";"):
        condition, name = (part.strip() for part in item.split(","))
        pairs.append((condition, name))
    return pairs


def apply_soft_filters(variants: DataFrame, filters: list[tuple[str, str]]) -> DataFrame:
    """Append the name of every condition that holds to ``filter``; rows stay, none means PASS.

    Conditions are SQL over the variant columns (``&&`` and ``||`` are read as AND and OR); a
    missing value makes no condition hold.
    """
    named = [
        F.when(F.expr(condition.replace("&&", " AND ").replace("||", " OR ")), F.lit(name))
        for condition, name in filters
    ]
    before = F.filter(F.coalesce("filter", F.array().cast("array<string>")), lambda f: f != "PASS")
    every = F.array_distinct(F.concat(before, F.array_compact(F.array(*named))))
    return variants.withColumn("filter", F.when(F.size(every) == 0, F.array(F.lit("PASS"))).otherwise(every))


def passes() -> Column:
    """No soft filter failed."""
    return F.col("filter") == F.array(F.lit("PASS"))


def phase_input(variants: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Variants that can be phased: passing, called 0/1 or 0/2 and, where (chrom, start, end) regions are given, inside one."""
    g0, g1 = F.element_at("gt", 1), F.element_at("gt", 2)
    kept = variants.where(passes() & (F.size("gt") == 2) & (g0 == 0) & g1.isin(1, 2))
    if regions is None:
        return kept
    places = kept.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end")).distinct()
    wanted = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    inside = overlap_join(places, wanted, 1 << 14).select("chrom", F.col("start").alias("pos")).distinct().withColumn("_in", F.lit(True))
    return lookup(kept, inside, ["chrom", "pos"]).where(F.col("_in")).drop("_in")


def large_insertions(calls: DataFrame) -> DataFrame:
    """Passing insertions assembled only at one or both ends."""
    return calls.where(
        (F.col("svtype") == "INS")
        & passes()
        & (F.col("left_svinsseq").isNotNull() | F.col("right_svinsseq").isNotNull())
    )


def block_rows(variants: DataFrame, indels: bool = False) -> DataFrame:
    """Phased heterozygous variants in blocks of two or more: ``chrom, ps, idx, pos, g0, g1, alleles``.

    Variants without a phase set form one block, which is left out on chromosomes that have others.
    """
    rows = checkpointed(
        index_variants(variants).where(heterozygous(indels) & F.col("phased")).select(
            "chrom",
            F.coalesce("ps", F.lit(NO_PHASE_SET)).cast("long").alias("ps"),
            "idx",
            "pos",
            F.element_at("gt", 1).alias("g0"),
            F.element_at("gt", 2).alias("g1"),
            alleles().alias("alleles"),
        )
    )
    blocks = rows.groupBy("chrom", "ps").agg(F.count(F.lit(1)).alias("n"))
    sets = blocks.groupBy("chrom").agg(F.count(F.lit(1)).alias("sets"))
    kept = blocks.join(sets, "chrom").where(
        (F.col("n") > 1) & ((F.col("ps") != NO_PHASE_SET) | (F.col("sets") == 1))
    )
    flagged = lookup(rows, kept.select("chrom", "ps", F.lit(True).alias("_kept")), ["chrom", "ps"])
    return flagged.where(F.col("_kept")).drop("_kept")


def block_spans(rows: DataFrame) -> DataFrame:
    """Per block: variants, bp span, and span adjusted for the records it leaves unphased."""
    ends = rows.groupBy("chrom", "ps").agg(
        F.count(F.lit(1)).alias("variants"),
        F.min_by("pos", "idx").alias("first"),
        F.max_by("pos", "idx").alias("last"),
        (F.max("idx") - F.min("idx") + 1).alias("index_span"),
    )
    span = F.col("last") - F.col("first")
    return ends.select(
        "chrom",
        "ps",
        "variants",
        span.alias("span"),
        (span * (F.col("variants") / F.col("index_span"))).alias("adjusted_span"),
    )


def block_intervals(variants: DataFrame) -> DataFrame:
    """Phase sets as 1-based intervals (chrom, ps, start, stop)."""
    phased = variants.where(F.col("phased") & F.col("ps").isNotNull() & (F.col("ps") != 0))
    return phased.groupBy("chrom", "ps").agg(
        (F.min("pos") + 1).alias("start"), (F.max("pos") + 1).alias("stop")
    )


def phasing_statistics(variants: DataFrame) -> DataFrame:
    """Per chromosome and for ALL: variant, phasing and block-size numbers."""
    het = heterozygous(indels=True)
    snv = het & is_snv()
    marked = checkpointed(
        variants.select("chrom", "pos", "ps", het.alias("het"), snv.alias("snv"), F.col("phased").alias("phased"))
    )
    in_set = marked.where("het AND phased")
    sets = in_set.groupBy("chrom", "ps").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("snv").alias("snvs"), (F.max("pos") - F.min("pos")).alias("bp")
    )
    sets = checkpointed(_with_all(sets))
    counts = _with_all(marked).groupBy("chrom").agg(
        F.count(F.lit(1)).alias("variants"),
        F.count_if("het").alias("heterozygous_variants"),
        F.count_if("snv").alias("heterozygous_snvs"),
    )
    blocks = sets.where("n > 1")
    summary = sets.groupBy("chrom").agg(F.count_if(F.col("n") == 1).alias("singletons"))
    sizes = blocks.groupBy("chrom").agg(
        F.sum("n").alias("phased"),
        F.sum("snvs").alias("phased_snvs"),
        F.count(F.lit(1)).alias("blocks"),
        F.avg("n").alias("variant_per_block_avg"),
        F.min("n").alias("variant_per_block_min"),
        F.max("n").alias("variant_per_block_max"),
        F.avg("bp").alias("bp_per_block_avg"),
        F.min("bp").alias("bp_per_block_min"),
        F.max("bp").alias("bp_per_block_max"),
        F.sum("bp").alias("bp_per_block_sum"),
    )
    median_n = exact_quantiles(blocks, "n", {"variant_per_block_median": 0.5}, ["chrom"])
    median_bp = exact_quantiles(blocks, "bp", {"bp_per_block_median": 0.5}, ["chrom"])
    joined = counts
    for part in (summary, sizes, median_n, median_bp):
        joined = joined.join(part, "chrom", "left")
    zero = ["singletons", "phased", "phased_snvs", "blocks"]
    return joined.fillna(0, zero).withColumn(
        "unphased", F.col("heterozygous_variants") - F.col("phased") - F.col("singletons")
    )


def _with_all(df: DataFrame) -> DataFrame:
    """Every row once under its chromosome and once under ALL."""
    return df.withColumn("chrom", F.explode(F.array("chrom", F.lit("ALL"))))
