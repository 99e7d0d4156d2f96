"""Haplotype accuracy of one phased VCF against another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators import phasing, variants
from tagweave.session import checkpointed
from tagweave.sources import genomics


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def _blocks(spark: SparkSession, path: str | None, indels: bool, chromosomes: Sequence[str] | None) -> DataFrame:
    if path is None:
        schema = "chrom string, ps bigint, idx bigint, pos bigint, g0 int, g1 int, alleles array<string>"
        return spark.createDataFrame([], schema)
    parsed = genomics.parse_vcf(_lines(spark, path))
    if chromosomes:
        parsed = parsed.where(F.col("chrom").isin(*chromosomes))
    return variants.block_rows(parsed, indels)


def compare_vcfs(
    spark: SparkSession,
    phased: str,
    truth: str | None = None,
    indels: bool = False,
    chromosomes: Sequence[str] | None = None,
    reference_lengths: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(metrics per chromosome and All, contiguity curves).

    Lengths come from a FASTA index when given, else from the header of the phased VCF.
    """
    asm = checkpointed(_blocks(spark, phased, indels, chromosomes))
    ref = checkpointed(_blocks(spark, truth, indels, chromosomes))
    if reference_lengths:
        lengths = genomics.parse_fai(_lines(spark, reference_lengths)).withColumnRenamed("name", "chrom")
    else:
        lengths = genomics.vcf_contig_lengths(_lines(spark, phased))
    pairs, segments = phasing.compare_phasings(asm, ref)
    segments = checkpointed(segments)
    report = phasing.haplotype_report(asm, ref, lengths, (pairs, segments))
    total = phasing.genome_lengths(asm.select("chrom"), lengths).where("chrom = 'All'").first()
    genome = total["genome"] if total else None
    return report, phasing.contiguity_curves(variants.block_spans(asm), segments, genome)
