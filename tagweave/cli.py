"""Command line: one subcommand per tool. Alignments are SAM text or parquet folders.

Run with ``spark-submit`` on a cluster, or ``python -m tagweave`` locally.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave import config
from tagweave.functions.skew import lookup
from tagweave.operators import barcodes as bc
from tagweave.operators import components, duplicates, molecules
from tagweave.operators import reads as rd
from tagweave.operators import statistics as st
from tagweave.plans import haplotypes, tagging
from tagweave.plans.linked_reads import read_pairs
from tagweave.session import build_session, checkpointed
from tagweave.sinks import layouts, tables as sinks
from tagweave.sources import genomics, sequences, tables

# Mappers whose input forms are known.
MAPPERS = ("ema", "lariat", "bwa", "bowtie2", "minimap2")
KNOWN_TAGS = {"BX", "RX", "MI", "HP", "PS", "PC"}
COMMANDS: dict[str, tuple[Callable, Callable]] = {}


def command(name: str, arguments: Callable[[argparse.ArgumentParser], None]):
    """Register a subcommand."""

    def register(run: Callable[[SparkSession, argparse.Namespace], None]):
        COMMANDS[name] = (run, arguments)
        return run

    return register


def exchange_tag(reads: DataFrame, column: str, put: str, take: str) -> DataFrame:
    """Store ``column`` as tag ``put`` and load it with tag ``take``."""
    if take in KNOWN_TAGS and put in KNOWN_TAGS:
        return reads.withColumns({c.lower(): F.col(o.lower()).cast(reads.schema[c.lower()].dataType) for c, o in ((put, take), (take, put))})
    kind = "i" if column == "mi" else "Z"
    own = F.when(F.col(column).isNotNull(), F.create_map(F.lit(put), F.concat(F.lit(f"{kind}:"), F.col(column).cast("string"))))
    held = F.try_element_at("tags", F.lit(take))
    kept = F.map_filter("tags", lambda k, _: ~k.isin(take, put))
    return reads.withColumns(
        {
            column: F.substring(held, F.lit(3), F.length(held)).cast(reads.schema[column].dataType),
            "tags": F.map_concat(kept, F.coalesce(own, F.create_map().cast("map<string,string>"))),
        }
    )


def load_alignments(spark: SparkSession, path: str, barcode_tag: str = "BX", molecule_tag: str = "MI") -> DataFrame:
    """Alignments with the named tags in columns ``bx`` and ``mi``; the tags of these names wait in ``tags``."""
    reads = spark.read.parquet(path) if path.endswith(".parquet") else genomics.read_sam(spark, path)
    for tag, column in ((barcode_tag, "bx"), (molecule_tag, "mi")):
        if tag != column.upper():
            reads = exchange_tag(reads, column, column.upper(), tag)
    return reads


def tag_column(tag: str):
    """Value of any SAM tag as text."""
    if tag in KNOWN_TAGS:
        return F.col(tag.lower()).cast("string")
    return F.expr(f"substring(tags['{tag}'], 3)")


def save_alignments(reads: DataFrame, path: str, barcode_tag: str = "BX", molecule_tag: str = "MI") -> None:
    """Parquet when the path says so, else SAM text; ``bx`` and ``mi`` are stored under the named tags."""
    for tag, column in ((barcode_tag, "bx"), (molecule_tag, "mi")):
        if tag != column.upper():
            reads = exchange_tag(reads, column, tag, column.upper())
    if path.endswith(".parquet"):
        reads.write.mode("overwrite").parquet(path)
    else:
        reads.select(genomics.sam_line().alias("value")).write.mode("overwrite").text(path)


def _show_counts(rows: DataFrame, **counters: Column) -> None:
    """Print counters of a tool's rows, one aggregate for all of them."""
    found = rows.agg(*[counter.alias(name) for name, counter in counters.items()]).first()
    for name in counters:
        print(f"{name.replace('_', ' ').capitalize():<40} {found[name] or 0:>15,}")


def _alignment_arguments(parser: argparse.ArgumentParser, output: bool = True) -> None:
    parser.add_argument("input")
    if output:
        parser.add_argument("-o", "--output", required=True)
    parser.add_argument("-b", "--barcode-tag", default="BX")


def _molecule_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("-t", "--threshold", type=int, default=molecules.DEFAULT_MIN_READS)
    parser.add_argument("-m", "--molecule-tag", default="MI")
    parser.add_argument("--bed")
    parser.add_argument("--min-mapq", type=int, default=0)
    parser.add_argument("-l", "--library-type", default="dbs", choices=sorted(molecules.TOLERATED_OVERLAP))


def _save_molecules(table: DataFrame, stats: str | None, bed: str | None) -> None:
    if stats:
        sinks.write_tsv(table.select(*tables.MOLECULE_COLUMNS), stats)
    if bed:
        sinks.write_bed(sinks.molecule_bed(table), bed)


def _buildmolecules_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser)
    _molecule_arguments(parser)
    parser.add_argument("-w", "--window", type=int, default=molecules.DEFAULT_WINDOW)
    parser.add_argument("-s", "--stats-tsv")


@command("buildmolecules", _buildmolecules_arguments)
def buildmolecules(spark: SparkSession, args: argparse.Namespace) -> None:
    """Molecules from barcoded alignments; reads get their molecule's number."""
    reads = load_alignments(spark, args.input, args.barcode_tag, args.molecule_tag)
    options = (args.library_type, args.window, args.threshold, args.min_mapq)
    table = checkpointed(molecules.molecule_table(molecules.build_molecules(reads, *options)))
    tagged = molecules.number_reads(reads, table, *options)
    save_alignments(tagged, args.output, args.barcode_tag, args.molecule_tag)
    _save_molecules(table, args.stats_tsv, args.bed)
    molecules.molecule_summary(table).show(truncate=False)


def _readmolecules_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser, output=False)
    _molecule_arguments(parser)
    parser.add_argument("-o", "--output-tsv", required=True)


@command("readmolecules", _readmolecules_arguments)
def readmolecules(spark: SparkSession, args: argparse.Namespace) -> None:
    """Molecules of alignments that already carry molecule numbers."""
    reads = load_alignments(spark, args.input, args.barcode_tag, args.molecule_tag)
    found = checkpointed(molecules.read_molecules(reads, args.library_type, args.threshold, args.min_mapq))
    table = found.select(
        F.col("mi").alias("MoleculeID"), F.col("bx").alias("Barcode"), "Reads", "Length", "BpCovered",
        F.col("rname").alias("Chromosome"), "StartPosition", "EndPosition",
    )
    _save_molecules(table, args.output_tsv, args.bed)
    molecules.molecule_summary(table).show(truncate=False)


def _clusterdups_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser, output=False)
    parser.add_argument("--output-merges", required=True)
    parser.add_argument("-w", "--window", type=int, default=30000)
    parser.add_argument("--min-mapq", type=int, default=0)
    parser.add_argument("-q", "--quantile-threshold", type=float, default=0.99)
    parser.add_argument("-l", "--library-type", default="dbs", choices=sorted(molecules.TOLERATED_OVERLAP))


@command("find_clusterdups", _clusterdups_arguments)
def find_clusterdups(spark: SparkSession, args: argparse.Namespace) -> None:
    """Barcodes of one droplet, written as old,new pairs."""
    pairs = checkpointed(read_pairs(load_alignments(spark, args.input, args.barcode_tag), args.min_mapq))
    edges = duplicates.droplet_links(duplicates.seed_positions(pairs, args.quantile_threshold), args.library_type, args.window)
    labels = checkpointed(components.connected_components(edges))
    sinks.write_merges(labels, args.output_merges)
    _show_counts(pairs, proper_pairs=F.count(F.lit(1)), barcodes=F.count_distinct("bx"))
    _show_counts(labels, merged_barcodes=F.count_if(F.col("node") != F.col("label")))


def _merge_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser)
    parser.add_argument("input_merges")


@command("merge_clusterdups", _merge_arguments)
def merge_clusterdups(spark: SparkSession, args: argparse.Namespace) -> None:
    """Replace barcodes by the ones they merge into."""
    reads = load_alignments(spark, args.input, args.barcode_tag)
    save_alignments(components.retag(reads, tables.read_merges(spark, args.input_merges)), args.output, args.barcode_tag)


def _filter_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser)
    parser.add_argument("barcodes")
    parser.add_argument("-m", "--molecule-tag", default="MI")


@command("filterclusters", _filter_arguments)
def filterclusters(spark: SparkSession, args: argparse.Namespace) -> None:
    """Strip listed barcodes from reads."""
    reads = load_alignments(spark, args.input, args.barcode_tag, args.molecule_tag)
    listed = tables.read_words(spark, args.barcodes)
    save_alignments(rd.strip_barcodes(reads, listed), args.output, args.barcode_tag, args.molecule_tag)
    rd.stripped_tag_counts(reads, listed).show(truncate=False)


def _get_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("input")
    parser.add_argument("tag")
    parser.add_argument("values", nargs="+")
    parser.add_argument("-o", "--output", required=True)


@command("get", _get_arguments)
def get(spark: SparkSession, args: argparse.Namespace) -> None:
    """Reads whose tag has one of the values, and how many each value has."""
    reads = load_alignments(spark, args.input).withColumn("_wanted", tag_column(args.tag))
    values = tables.requested_values(spark, args.values)
    save_alignments(st.rows_with_values(reads, "_wanted", values).drop("_wanted"), args.output)
    st.value_counts(reads, "_wanted", values).orderBy(F.desc("count"), "value").show(truncate=False)


def _correct_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("uncorrected_barcodes")
    parser.add_argument("-o", "--output", required=True)


@command("correctbc", _correct_arguments)
def correctbc(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cluster table from raw barcode reads."""
    counts = checkpointed(bc.count_barcodes(sequences.read_fastq(spark, args.uncorrected_barcodes), "sequence"))
    clusters = checkpointed(bc.correct_singles(counts))
    sinks.write_clusters(clusters, args.output)
    _show_counts(counts, barcode_reads=F.sum("n"), raw_barcodes=F.count(F.lit(1)))
    _show_counts(clusters, clusters=F.count(F.lit(1)))


def _tagbam_arguments(parser: argparse.ArgumentParser) -> None:
    _alignment_arguments(parser)
    parser.add_argument("-s", "--sample-nr", type=int, default=1)


@command("tagbam", _tagbam_arguments)
def tagbam(spark: SparkSession, args: argparse.Namespace) -> None:
    """Move barcode information from names to tags."""
    reads = load_alignments(spark, args.input, args.barcode_tag)
    moved = rd.tags_from_names(reads, rd.detect_mode(reads), args.sample_nr, name_tag=args.barcode_tag)
    save_alignments(moved, args.output, args.barcode_tag)
    _show_counts(moved, total_reads=F.count(F.lit(1)), reads_with_barcode=F.count("bx"), reads_with_raw_barcode=F.count("rx"))


def _fastq_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("input1")
    parser.add_argument("input2", nargs="?")
    parser.add_argument("-o", "--output", required=True)
    parser.add_argument("--nr-bins", type=int, default=100)
    parser.add_argument("-m", "--mapper", default="bowtie2", choices=MAPPERS)
    parser.add_argument("--sample-nr", type=int, default=1)
    parser.add_argument("-b", "--barcode-tag", default="BX")


def _save_tagged(tagged: tagging.TaggedPairs, args: argparse.Namespace, plain_bins: bool = False) -> None:
    if args.mapper in bc.SORTED_MAPPERS:
        record = layouts.nine_line_record(args.sample_nr) if args.mapper == "lariat" else layouts.interleaved_record()
        layouts.write_bins(tagged.barcoded, f"{args.output}/bins", layouts.bin_record() if plain_bins else record)
        layouts.write_fastq_pairs(tagged.other, f"{args.output}/non_barcoded")
    else:
        layouts.write_fastq_pairs(tagged.barcoded, args.output)


def _tagfastq_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("uncorrected_barcodes")
    parser.add_argument("corrected_barcodes")
    _fastq_arguments(parser)
    parser.add_argument("--min-count", type=int, default=0)
    parser.add_argument("-p", "--pattern-match")
    parser.add_argument("-s", "--sequence-tag", default="RX")


@command("tagfastq", _tagfastq_arguments)
def tagfastq(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write corrected barcodes into read pairs."""
    raw = sequences.barcode_reads(sequences.read_fastq(spark, args.uncorrected_barcodes))
    pairs = sequences.read_fastq_pairs(spark, args.input1, args.input2)
    clusters = tables.read_clusters(spark, args.corrected_barcodes)
    options = (args.mapper, args.min_count, args.pattern_match, args.nr_bins, args.barcode_tag, args.sequence_tag)
    tagged = tagging.tag_pairs(pairs, raw, clusters, *options)
    _save_tagged(tagged, args)
    _show_counts(
        tagged.barcoded.select("barcode").unionByName(tagged.other.select("barcode")),
        read_pairs=F.count(F.lit(1)), read_pairs_missing_barcode=F.count_if(F.col("barcode").isNull()),
    )


def _stlfr_arguments(parser: argparse.ArgumentParser) -> None:
    _fastq_arguments(parser)
    parser.add_argument("--output-translations")


@command("process_stlfr", _stlfr_arguments)
def process_stlfr(spark: SparkSession, args: argparse.Namespace) -> None:
    """Give three-part indices generated barcodes and write them into read pairs."""
    pairs = sequences.read_fastq_pairs(spark, args.input1, args.input2)
    parsed = checkpointed(bc.parse_indexed_names(pairs))
    codes = checkpointed(bc.generated_barcodes(parsed, "index", "place", 1 << 40))
    joined = lookup(parsed, codes, "index").withColumn("name", F.col("read_name"))
    if args.mapper not in bc.SORTED_MAPPERS:
        named = F.when(F.col("barcode").isNotNull(), F.concat("name", F.lit(f"_{args.barcode_tag}:Z:"), "barcode")).otherwise(F.col("name"))
        joined = joined.withColumn("name", named)
    joined = joined.withColumn("name2", F.col("name"))
    if args.mapper == "ema":
        # Bins of the six-field form are dealt in turn.
        ranks = bc.round_robin_bins(parsed.where("index IS NOT NULL"), "index", "place", args.nr_bins, 1 << 40)
        binned = lookup(joined, ranks, "index").where("barcode IS NOT NULL").withColumn("heap", F.col("barcode"))
        _save_tagged(tagging.TaggedPairs(binned, joined.where("barcode IS NULL")), args, plain_bins=True)
    elif args.mapper == "lariat":
        binned = tagging.packed(checkpointed(joined), bc.heap_order(codes.withColumnRenamed("barcode", "canonical")), args.nr_bins)
        _save_tagged(binned, args)
    else:
        _save_tagged(tagging.TaggedPairs(joined, joined.limit(0)), args)
    _show_counts(
        parsed, read_pairs=F.count(F.lit(1)), read_pairs_missing_barcode=F.count_if(F.col("index").isNull()), barcodes=F.count_distinct("index")
    )
    if args.output_translations:
        codes.write.mode("overwrite").csv(args.output_translations)


def _haplotype_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("-v1", "--vcf1", required=True)
    parser.add_argument("-v2", "--vcf2")
    parser.add_argument("--indels", action="store_true")
    parser.add_argument("--per-chrom", action="store_true")
    parser.add_argument("-c", "--chromosomes")
    parser.add_argument("-s", "--stats")
    parser.add_argument("-o", "--output", required=True)
    parser.add_argument("-r", "--reference-lengths")


@command("calculate_haplotype_statistics", _haplotype_arguments)
def calculate_haplotype_statistics(spark: SparkSession, args: argparse.Namespace) -> None:
    """Haplotype metrics and contiguity curves."""
    chosen = args.chromosomes.split(",") if args.chromosomes else None
    report, curves = haplotypes.compare_vcfs(spark, args.vcf1, args.vcf2, args.indels, chosen, args.reference_lengths)
    rows = report if args.per_chrom else report.where("chrom = 'All'")
    names = [c for c in rows.columns if c != "chrom"]
    text = rows.select("chrom", *[F.col(c).cast("string").alias(c) for c in names]).unpivot("chrom", names, "metric", "value")
    sinks.write_tsv(text.fillna("n/a", ["value"]), args.output)
    if args.stats:
        sinks.write_tsv(curves, args.stats, header=False)


def _config_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("-s", "--set", nargs=2, action="append", default=[])
    parser.add_argument("-f", "--file", type=Path, required=True)
    parser.add_argument("-u", "--update-from", type=Path)


@command("config", _config_arguments)
def change_config(spark: SparkSession | None, args: argparse.Namespace) -> None:
    """Show or change a settings file."""
    changes = [tuple(pair) for pair in args.set]
    if args.update_from:
        changes = config.combined_changes(changes, config.yaml.safe_load(args.update_from.read_text()))
    if changes:
        config.change_file(args.file, changes)
    else:
        print(args.file.read_text())


def main(argv: list[str] | None = None) -> None:
    """Parse arguments and run one subcommand."""
    parser = argparse.ArgumentParser(prog="tagweave", description=__doc__)
    chosen = parser.add_subparsers(dest="command", required=True)
    for name, (run, arguments) in COMMANDS.items():
        arguments(chosen.add_parser(name, help=run.__doc__))
    args = parser.parse_args(argv)
    run, _ = COMMANDS[args.command]
    run(None if args.command == "config" else build_session(args.command), args)
