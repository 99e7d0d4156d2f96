"""FASTQ and FASTA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.sources.lines import carried_section, grouped_lines, numbered_lines


def parse_fastq(lines: DataFrame) -> DataFrame:
    """(path, record, name, sequence, quality) from numbered lines; ``name`` is the whole header."""
    rows = grouped_lines(lines, 4, ["_head", "sequence", "_plus", "quality"])
    return rows.select("path", "record", F.expr("substring(_head, 2)").alias("name"), "sequence", "quality")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """One FASTQ file or folder (plain or compressed)."""
    return parse_fastq(numbered_lines(spark, path))


def _numbered_files(reads: DataFrame) -> DataFrame:
    """``reads`` with ``file``: the place of their path among all paths."""
    # One row per file.
    files = reads.select("path").distinct().withColumn("file", F.row_number().over(Window.orderBy("path")) - 1)
    return lookup(reads, files, "path")


def _ordered(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``place``: a number that is unique and follows files, then records."""
    return pairs.withColumn("place", F.shiftleft(F.col("file").cast("long"), 40) + F.col("record"))


def interleaved_pairs(reads: DataFrame) -> DataFrame:
    """Consecutive records of a file as pairs (file, record, place, name, r1_seq, r1_qual, name2, r2_seq, r2_qual)."""
    second = F.col("record") % 2 == 1

    def pick(side, column: str, name: str):
        return F.max(F.when(side, F.col(column))).alias(name)

    pairs = reads.groupBy("path", F.floor(F.col("record") / 2).alias("record")).agg(
        pick(~second, "name", "name"),
        pick(~second, "sequence", "r1_seq"),
        pick(~second, "quality", "r1_qual"),
        pick(second, "name", "name2"),
        pick(second, "sequence", "r2_seq"),
        pick(second, "quality", "r2_qual"),
    )
    return _ordered(_numbered_files(pairs))


def parallel_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records of two parallel sets of files as pairs: the k-th path of one side goes with the k-th of the other.

    Both sides are sorted and merged whatever their files' size, which compression makes a poor measure of the rows.
    """
    one = _numbered_files(first).select("file", "record", "name", F.col("sequence").alias("r1_seq"), F.col("quality").alias("r1_qual"))
    two = _numbered_files(second).select(
        "file",
        "record",
        F.col("name").alias("name2"),
        F.col("sequence").alias("r2_seq"),
        F.col("quality").alias("r2_qual"),
    )
    return _ordered(one.hint("merge").join(two, ["file", "record"]))


def read_fastq_pairs(spark: SparkSession, first: str, second: str | None = None) -> DataFrame:
    """Read pairs of two parallel files or folders, or of interleaved files."""
    if second is None:
        return interleaved_pairs(read_fastq(spark, first))
    return parallel_pairs(read_fastq(spark, first), read_fastq(spark, second))


def parse_fasta(lines: DataFrame) -> DataFrame:
    """(path, line_no, name, comment, sequence): sequences may span lines, joined in order."""
    head = F.col("line").startswith(">")
    place = F.format_string("%020d %s", "line_no", F.expr("substring(line, 2)"))
    tagged = carried_section(lines, head, place, "")
    body = tagged.where(~head).groupBy("path", "section").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_rows")
    )
    header = F.expr("substring(section, 22)")
    return body.select(
        "path",
        F.substring("section", 1, 20).cast("long").alias("line_no"),
        F.substring_index(header, " ", 1).alias("name"),
        F.when(header.contains(" "), F.expr("substring(substring(section, 22), instr(substring(section, 22), ' ') + 1)")).alias("comment"),
        F.array_join(F.transform("_rows", lambda r: r["line"]), "").alias("sequence"),
    )


def barcode_reads(reads: DataFrame) -> DataFrame:
    """(read_name, raw_barcode): names end at their first space."""
    return reads.select(F.substring_index("name", " ", 1).alias("read_name"), F.col("sequence").alias("raw_barcode"))
