"""Haplotype accuracy: switch, mismatch and flat errors between two phasings.

Along a pair of overlapping blocks, let x be whether the assembled allele differs from the true
one. A *flip* is a change of x between neighbouring comparable variants. Two flips in a row are one
mismatching variant, a lone flip is a switch, and a flip at the very end of the block is a mismatch.
So within a run of k flips the 2nd, 4th, ... are mismatches and an odd k leaves a switch: the walk is
a gaps-and-islands problem and needs no per-block collection. The opening run is shifted by one when
the block begins with an odd number of flips.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.orderstats import area_under_nx, exact_quantiles, nx, nx_curve
from tagweave.functions.scans import (
    following,
    ordered_scan,
    previous,
    prior_max,
    row_index,
    running_max,
    total_min,
    total_sum,
)
from tagweave.functions.skew import lookup
from tagweave.operators.variants import block_spans
from tagweave.session import checkpointed

PAIR = ["chrom", "ref_ps", "ps"]
WIDTH = 1 << 16


def _common_variants(asm: DataFrame, ref: DataFrame) -> DataFrame:
    """Assembled variants met in a true block, numbered within their own block (``ord``)."""
    numbered = ordered_scan(asm, ["chrom", "ps"], "idx", WIDTH, ord=row_index())
    truth = ref.groupBy("chrom", F.col("ps").alias("ref_ps"), "pos").agg(
        F.max_by(F.struct("g0", "g1", "alleles"), "idx").alias("t")
    )
    joined = numbered.join(truth, ["chrom", "pos"])
    same = ((F.col("g0") == F.col("t.g0")) & (F.col("g1") == F.col("t.g1"))) | (
        (F.col("g0") == F.col("t.g1")) & (F.col("g1") == F.col("t.g0"))
    )
    return joined.select(
        *PAIR,
        "idx",
        "pos",
        "ord",
        (same & (F.col("alleles") == F.col("t.alleles"))).alias("usable"),
        (F.col("t.g0") != F.col("g0")).alias("x0"),
        (F.col("t.g0") != F.col("g1")).alias("x1"),
    )


def _opening_parity(common: DataFrame) -> DataFrame:
    """Per pair, whether the block opens with an odd number of flips (``odd0, odd1`` by allele).

    Counted from the first comparable variant over neighbours in the assembled block, up to the
    first variant that is unknown in the truth or does not flip.
    """
    rows = ordered_scan(
        common,
        PAIR,
        "idx",
        WIDTH,
        at=row_index(),
        before=previous(F.struct("ord", "x0", "x1")),
        size=total_sum(F.lit(1)),
        first_idx=total_min(F.when(F.col("usable"), F.col("idx"))),
    )
    gap = F.col("ord") - F.col("before.ord") > 1
    later = F.col("before").isNotNull() & (F.col("idx") > F.col("first_idx"))

    def end(side: str) -> Column:
        stop = gap | (F.col(side) == F.col(f"before.{side}"))
        return F.min(F.when(later & stop, F.col("at")))

    found = rows.where(F.col("first_idx").isNotNull()).groupBy(*PAIR).agg(
        F.min(F.when(F.col("usable"), F.col("at"))).alias("first"), F.max("size").alias("size"), end("x0").alias("end0"), end("x1").alias("end1")
    )

    def odd(name: str) -> Column:
        return (F.coalesce(F.col(name), F.col("size") + 1) - F.col("first") - 1) % 2 == 1

    return found.select(*PAIR, odd("end0").alias("odd0"), odd("end1").alias("odd1"))


def _error_kind(odd: str) -> Column:
    """``switch``, ``mismatch`` or NULL for a comparable variant, given the opening parity."""
    opening = (F.col("calm") == 1) & F.col(odd)
    place = F.col("at") - F.col("calm") + F.when(opening, 1).otherwise(0)
    last = F.col("at") == F.col("size")
    flip_kind = (
        F.when((place % 2 == 0) | last, F.lit("mismatch"))
        .when(~F.coalesce("next_flip", F.lit(False)), F.lit("switch"))
    )
    alone = (F.col("at") == 1) & last & F.col(odd)
    return F.when(F.col("flip"), flip_kind).when(alone, F.lit("mismatch"))


def compare_phasings(asm: DataFrame, ref: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per block pair counts, error-split segments) of two phasings' block rows.

    Pair counts: ``switches, mismatches, comparable, flat``. Segments: ``span, variants,
    adjusted_span`` of the stretches between errors.
    """
    common = checkpointed(_common_variants(asm, ref))
    parity = _opening_parity(common)
    usable = checkpointed(
        ordered_scan(
            common.where("usable"),
            PAIR,
            "idx",
            WIDTH,
            at=row_index(),
            size=total_sum(F.lit(1)),
            before=previous(F.struct("x0", "pos", "idx")),
        ).withColumn("flip", F.coalesce(F.col("x0") != F.col("before.x0"), F.lit(False)))
    )
    scanned = ordered_scan(
        usable,
        PAIR,
        "idx",
        WIDTH,
        calm=running_max(F.when(~F.col("flip"), F.col("at"))),
        next_flip=following(F.col("flip")),
        before2=previous(F.col("before")),
    )
    runs = lookup(scanned, parity, PAIR)
    judged = checkpointed(runs.withColumn("kind0", _error_kind("odd0")).withColumn("kind1", _error_kind("odd1")))

    def errors(kind: str, which: str) -> Column:
        return F.count_if(F.col(kind) == which)

    pairs = judged.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("comparable"),
        errors("kind0", "switch").alias("s0"),
        errors("kind1", "switch").alias("s1"),
        errors("kind0", "mismatch").alias("m0"),
        errors("kind1", "mismatch").alias("m1"),
        F.least(F.count_if("x0"), F.count_if("x1")).alias("flat"),
    )
    first = F.col("s0") < F.col("s1")
    pairs = checkpointed(
        pairs.select(
            *PAIR,
            "comparable",
            "flat",
            F.when(first, F.col("s0")).otherwise(F.col("s1")).alias("switches"),
            F.when(first, F.col("m0")).otherwise(F.col("m1")).alias("mismatches"),
            first.alias("first_allele"),
        )
    )
    kind = F.when(F.col("first_allele"), F.col("kind0")).otherwise(F.col("kind1"))
    marked = lookup(judged, pairs.select(*PAIR, "first_allele"), PAIR).withColumn("kind", kind)
    place = F.struct("at", "pos", "idx")
    cut = ordered_scan(
        marked, PAIR, "idx", WIDTH, since=prior_max(F.when(F.col("kind").isNotNull() | (F.col("at") == 1), place))
    )
    reach = F.col("at") - F.col("since.at")
    ended = (
        F.when((F.col("kind") == "switch") & (reach > 1), F.struct(reach.alias("n"), F.col("before.pos").alias("pos"), F.col("before.idx").alias("idx")))
        .when(
            (F.col("kind") == "mismatch") & (reach > 2),
            F.struct((reach - 1).alias("n"), F.col("before2.pos").alias("pos"), F.col("before2.idx").alias("idx")),
        )
        .when(
            F.col("kind").isNull() & (F.col("at") == F.col("size")) & (reach > 0),
            F.struct((reach + 1).alias("n"), F.col("pos"), F.col("idx")),
        )
    )
    length = F.col("_e.pos") - F.col("since.pos")
    segments = (
        cut.withColumn("_e", ended)
        .where(F.col("_e").isNotNull())
        .select(
            *PAIR,
            F.col("_e.n").alias("variants"),
            length.alias("span"),
            (length * (F.col("_e.n") / (F.col("_e.idx") - F.col("since.idx") + 1))).alias("adjusted_span"),
        )
    )
    return pairs.drop("first_allele"), segments


def _by_chromosome_and_all(df: DataFrame) -> DataFrame:
    return df.withColumn("chrom", F.explode(F.array("chrom", F.lit("All"))))


def error_counts(pairs: DataFrame) -> DataFrame:
    """Error counts and possible positions per chromosome and overall (``chrom`` = All)."""
    comparable = F.col("comparable")
    return (
        pairs.rollup("chrom")
        .agg(
            F.sum("switches").alias("switch_count"),
            F.sum(F.when(comparable >= 4, comparable - 3).otherwise(0)).alias("switch_positions"),
            F.sum("mismatches").alias("mismatch_count"),
            F.sum(F.when(comparable >= 2, comparable).otherwise(0)).alias("mismatch_positions"),
            F.sum("flat").alias("flat_count"),
        )
        .withColumn("chrom", F.coalesce("chrom", F.lit("All")))
    )


def error_rates(counts: DataFrame) -> DataFrame:
    """Add rates; NULL where no position could err."""

    def rate(top: Column, bottom: str) -> Column:
        return F.try_divide(top.cast("double"), F.col(bottom))

    return counts.select(
        "*",
        F.col("mismatch_positions").alias("flat_positions"),
        rate(F.col("switch_count"), "switch_positions").alias("switch_rate"),
        rate(F.col("mismatch_count"), "mismatch_positions").alias("mismatch_rate"),
        rate(F.col("flat_count"), "mismatch_positions").alias("flat_rate"),
        rate(F.col("switch_count") + F.col("mismatch_count"), "mismatch_positions").alias("switch_mismatch_rate"),
    )


def genome_lengths(chromosomes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(chrom, genome) per chromosome and All; the total is NULL unless every length is known."""
    known = chromosomes.select("chrom").distinct().join(lengths.select("chrom", "length"), "chrom", "left")
    total = F.when(F.count("length") == F.count(F.lit(1)), F.sum("length"))
    return (
        known.rollup("chrom")
        .agg(total.alias("genome"))
        .withColumn("chrom", F.coalesce("chrom", F.lit("All")))
    )


# Marks statistics measured against the sum of their own weights.
OWN_TOTAL = -1


def _ranked(rows: DataFrame, stat: str, value: str, weight: str, goal: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of one contiguity statistic in the long form all of them share."""
    return rows.select(
        *keys,
        F.lit(stat).alias("stat"),
        goal.cast("long").alias("goal"),
        F.col(value).cast("double").alias("value"),
        F.col(weight).cast("long").alias("weight"),
    )


def _goal() -> Column:
    return F.when(F.col("goal") == OWN_TOTAL, F.col("total")).otherwise(F.col("goal"))


def haplotype_report(
    asm: DataFrame, ref: DataFrame, lengths: DataFrame | None = None, compared: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """All haplotype metrics per chromosome and for All, one row each; ``compared`` is a comparison made before."""
    if compared is None:
        asm, ref = checkpointed(asm), checkpointed(ref)
        compared = compare_phasings(asm, ref)
    pairs, segments = compared
    blocks = checkpointed(block_spans(asm))
    chroms = blocks.select("chrom").distinct()
    report = _by_chromosome_and_all(chroms).distinct()
    report = report.join(error_counts(pairs), "chrom", "left").fillna(0)
    report = checkpointed(error_rates(report))
    genome = genome_lengths(chroms, lengths) if lengths is not None else chroms.limit(0).select(
        "chrom", F.lit(None).cast("long").alias("genome")
    )
    totals = report.select("chrom", "mismatch_positions").join(genome, "chrom", "left")
    totals = totals.withColumn("genome", F.coalesce("genome", F.lit(-1)))

    known = F.when(F.col("genome") >= 0, F.col("genome"))
    squares = F.sum((F.col("span") * F.col("span")).cast("decimal(38,0)")).cast("double")
    ranked, areas = [], []
    for prefix, rows in (("", blocks), ("q", checkpointed(segments))):
        spans = _by_chromosome_and_all(rows.select("chrom", "variants", "span", "adjusted_span"))
        spans = spans.join(F.broadcast(totals), "chrom")
        ranked += [
            _ranked(spans, f"{prefix}n50", "span", "span", F.lit(OWN_TOTAL), ["chrom"]),
            _ranked(spans.where("genome >= 0"), f"{prefix}ng50", "span", "span", F.col("genome"), ["chrom"]),
            _ranked(spans, f"{prefix}an50", "adjusted_span", "variants", F.col("mismatch_positions"), ["chrom"]),
        ]
        areas.append(
            spans.groupBy("chrom").agg(
                area_under_nx("span").alias(f"au{prefix}n"),
                F.try_divide(squares, F.max(known)).alias(f"au{prefix}ng"),
            )
        )
    halves = nx(
        reduce(DataFrame.unionByName, ranked), "value", keys=["chrom", "stat", "goal"], weight="weight", total=_goal(), width=None
    )
    names = {f"{p}{n}": kind for p in ("", "q") for n, kind in (("n50", "long"), ("ng50", "long"), ("an50", "double"))}
    wide = halves.groupBy("chrom").agg(
        *[F.max(F.when(F.col("stat") == name, F.col("nx"))).cast(kind).alias(name) for name, kind in names.items()]
    )
    per_chrom = blocks.groupBy("chrom").agg(F.sum("variants").alias("phased_count"), F.max("variants").alias("largest"))
    in_ref = chroms.join(ref.groupBy("chrom").agg(F.count(F.lit(1)).alias("phased_count_ref")), "chrom", "left").fillna(0)
    sums = per_chrom.join(in_ref, "chrom").rollup("chrom").agg(
        F.sum("phased_count").alias("phased_count"),
        F.sum("phased_count_ref").alias("phased_count_ref"),
        F.sum("largest").alias("num_snps_max_blk"),
    ).withColumn("chrom", F.coalesce("chrom", F.lit("All")))
    medians = exact_quantiles(_by_chromosome_and_all(blocks.select("chrom", "span")), "span", {"median_block_length": 0.5}, ["chrom"])
    for part in [sums, wide, medians, *areas]:
        report = report.join(F.broadcast(part), "chrom", "left")
    return report.withColumns({
        "phased_rate_asm": F.when(F.col("phased_count_ref") > 0, F.try_divide(F.col("flat_positions"), F.col("phased_count"))),
        "phased_rate_ref": F.try_divide(F.col("flat_positions"), F.col("phased_count_ref")),
    })


def contiguity_curves(blocks: DataFrame, segments: DataFrame, genome: int | None = None) -> DataFrame:
    """(stat, x, y): NX, ANX, QNX, QAN and, with a genome length, NGX and QNG, x = 0..100."""
    curves = []
    for rows, plain, weighted, against in ((blocks, "NX", "ANX", "NGX"), (segments, "QNX", "QAN", "QNG")):
        rows = checkpointed(rows.select("span", "adjusted_span", "variants"))
        curves.append(_ranked(rows, plain, "span", "span", F.lit(OWN_TOTAL)))
        curves.append(_ranked(rows, weighted, "adjusted_span", "variants", F.lit(OWN_TOTAL)))
        if genome is not None:
            curves.append(_ranked(rows, against, "span", "span", F.lit(genome)))
    joined = reduce(DataFrame.unionByName, curves)
    return nx_curve(joined, "value", ["stat", "goal"], weight="weight", total=_goal(), width=None).select("stat", "x", "y")
