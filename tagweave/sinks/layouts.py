"""Record layouts of FASTQ and barcode-aware mapper inputs, and writers that split them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.dna import reverse_complement
from tagweave.operators.alleles import SECONDARY, SUPPLEMENTARY
from tagweave.session import checkpointed

REVERSE = 16
# Stands for missing qualities in FASTQ.
LOWEST_QUALITY = '"'


def fastq_record(name: Column, sequence: Column, quality: Column) -> Column:
    """Four FASTQ lines."""
    return F.concat(F.lit("@"), name, F.lit("\n"), sequence, F.lit("\n+\n"), quality)


def interleaved_record() -> Column:
    """Both reads of a pair (``name, name2, r1_seq, r1_qual, r2_seq, r2_qual``), one after the other."""
    first = fastq_record(F.col("name"), F.col("r1_seq"), F.col("r1_qual"))
    second = fastq_record(F.coalesce("name2", "name"), F.col("r2_seq"), F.col("r2_qual"))
    return F.concat(first, F.lit("\n"), second)


def bin_record() -> Column:
    """Six space-separated fields: barcode, @name, both sequences with their qualities."""
    return F.concat_ws(" ", "barcode", F.concat(F.lit("@"), F.col("name")), "r1_seq", "r1_qual", "r2_seq", "r2_qual")


def nine_line_record(sample_nr: int = 1) -> Column:
    """Nine lines: name, both reads, barcode with sample number and its quality, sample index."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("@"), F.col("name")),
        "r1_seq",
        "r1_qual",
        "r2_seq",
        "r2_qual",
        F.concat("barcode", F.lit(f"-{sample_nr}")),
        F.repeat(F.lit("K"), F.length("barcode")),
        F.lit("AAAAAA"),
        F.lit("KKKKKK"),
    )


def bin_rows_to_fastq(style: str = "ema") -> Column:
    """Interleaved FASTQ of a six-field bin row; the header names the barcode as the mapper wants it."""
    if style == "ema":
        header = F.concat("name", F.lit(":"), F.col("barcode"), F.lit(" BX:Z:"), F.col("barcode"), F.lit("-1"))
    else:
        header = F.concat("name", F.lit("_BX:Z:"), F.col("barcode"), F.lit("-1"))
    return F.concat(
        fastq_record(header, F.col("r1_seq"), F.col("r1_qual")),
        F.lit("\n"),
        fastq_record(header, F.col("r2_seq"), F.col("r2_qual")),
    )


def reads_of_alignments(alignments: DataFrame, tags: Sequence[str] = ("bx", "rx")) -> DataFrame:
    """(name, read, sequence, quality) as the sequencer gave them: reverse strands are turned back, secondary and supplementary records left out.

    ``read`` is 1 or 2, or 0 where flags name no single mate; ``name`` carries the tags that are set, after tabs. Reads without qualities get
    the lowest.
    """
    flag = F.col("flag")
    turned = flag.bitwiseAND(REVERSE) != 0
    bases = F.when(F.col("sequence") == "*", F.lit("")).otherwise(F.coalesce("sequence", F.lit("")))
    marks = F.when(F.col("quality").isNull() | (F.col("quality") == "*"), F.repeat(F.lit(LOWEST_QUALITY), F.length(bases))).otherwise(F.col("quality"))
    named = [F.concat(F.lit(f"{t.upper()}:Z:"), F.col(t).cast("string")) for t in tags if t in alignments.columns]
    side = F.when(flag.bitwiseAND(192) == 64, 1).when(flag.bitwiseAND(192) == 128, 2).otherwise(0)
    return alignments.where(flag.bitwiseAND(SECONDARY | SUPPLEMENTARY) == 0).select(
        F.concat_ws("\t", "qname", *named).alias("name"),
        "qname",
        side.alias("read"),
        F.when(turned, reverse_complement(bases)).otherwise(bases).alias("sequence"),
        F.when(turned, F.reverse(marks)).otherwise(marks).alias("quality"),
    )


def pairs_of_alignments(alignments: DataFrame, tags: Sequence[str] = ("bx", "rx")) -> DataFrame:
    """Read pairs (``name, name2, r1_seq, r1_qual, r2_seq, r2_qual``) of names with one first and one second read; other reads are in no pair."""
    reads = reads_of_alignments(alignments, tags)

    def pick(read: int, column: str, alias: str) -> Column:
        return F.min(F.when(F.col("read") == read, F.col(column))).alias(alias)

    columns = [("name", "name", "name2"), ("sequence", "r1_seq", "r2_seq"), ("quality", "r1_qual", "r2_qual")]
    picked = [pick(k, c, names[k - 1]) for c, *names in columns for k in (1, 2)]
    joined = reads.where("read > 0").groupBy("qname").agg(F.count_if(F.col("read") == 1).alias("_n1"), F.count_if(F.col("read") == 2).alias("_n2"), *picked)
    return joined.where("_n1 = 1 AND _n2 = 1").select("name", "name2", "r1_seq", "r1_qual", "r2_seq", "r2_qual")


def write_fastq_pairs(pairs: DataFrame, path: str, compression: str | None = "gzip") -> None:
    """Two folders, one per read of the pair, with rows in the same order: that of ``place`` where there is one, else of the names.

    Both are written from one sorted table on disk, so the sides cannot go out of step.
    """
    first = fastq_record(F.col("name"), F.col("r1_seq"), F.col("r1_qual"))
    second = fastq_record(F.coalesce("name2", "name"), F.col("r2_seq"), F.col("r2_qual"))
    order = ["place"] if "place" in pairs.columns else ["name", "r1", "r2"]
    rows = pairs.select(*[c for c in ("place", "name") if c in pairs.columns], first.alias("r1"), second.alias("r2"))
    held = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    for folder in ("r1", "r2"):
        held.select(F.col(folder).alias("value")).write.mode("overwrite").option("compression", compression or "none").text(f"{path}/{folder}")


def write_barcode_split(pairs: DataFrame, path: str, compression: str | None = "gzip") -> None:
    """Interleaved FASTQ in two folders: pairs with and without barcode."""
    for folder, keep in (("barcoded", F.col("barcode").isNotNull()), ("non_barcoded", F.col("barcode").isNull())):
        rows = pairs.where(keep).select(interleaved_record().alias("value"))
        rows.write.mode("overwrite").option("compression", compression or "none").text(f"{path}/{folder}")


def write_bins(pairs: DataFrame, path: str, record: Column) -> None:
    """One folder per ``bin`` with rows in heap order, so a barcode's rows are contiguous.

    Rows are range partitioned down to the record itself: a barcode with very many reads spans
    several consecutive files of its bin instead of one task.
    """
    rows = pairs.select("bin", "heap", record.alias("value"))
    order = ["bin", "heap", "value"]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.drop("heap").write.mode("overwrite").partitionBy("bin").text(path)
