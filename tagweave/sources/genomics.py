"""SAM, VCF, FAI, BED, GFA and structural variant text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.sources.lines import split_fields


def reference_length(cigar: Column) -> Column:
    """Bases of the reference an alignment covers."""
    numbers = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments with 0-based half-open coordinates and barcode / molecule / phase tags as columns.

    All other tags stay in the map ``tags`` (tag -> TYPE:value).
    """
    f = F.col("f")
    tag_items = F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0)))
    tags = F.map_from_entries(
        F.transform(tag_items, lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substring(t, F.lit(4), F.length(t)).alias("value")))
    )
    fields = split_fields(lines.where(~F.col("line").startswith("@")))
    rows = fields.select(F.explode(F.array(F.struct("f", tags.alias("tags")))).alias("_r")).select("_r.f", "_r.tags")

    def tag(name: str) -> Column:
        value = F.try_element_at("tags", F.lit(name))
        return F.substring(value, F.lit(3), F.length(value))

    def place(column: Column) -> Column:
        return F.when(column.cast("long") > 0, column.cast("long") - 1)

    start = place(F.col("f")[3])
    return rows.select(
        F.col("f")[0].alias("qname"),
        F.col("f")[1].cast("int").alias("flag"),
        F.nullif(F.col("f")[2], F.lit("*")).alias("rname"),
        start.alias("start"),
        (start + reference_length(F.col("f")[5])).alias("end"),
        F.col("f")[4].cast("int").alias("mapq"),
        F.col("f")[5].alias("cigar"),
        F.when(F.col("f")[6] == "=", F.col("f")[2]).otherwise(F.nullif(F.col("f")[6], F.lit("*"))).alias("mate_rname"),
        place(F.col("f")[7]).alias("mate_start"),
        F.col("f")[8].cast("int").alias("template_length"),
        F.col("f")[9].alias("sequence"),
        F.col("f")[10].alias("quality"),
        tag("BX").alias("bx"),
        tag("RX").alias("rx"),
        tag("MI").cast("long").alias("mi"),
        tag("HP").cast("int").alias("hp"),
        tag("PS").cast("long").alias("ps"),
        tag("PC").cast("int").alias("pc"),
        F.map_filter("tags", lambda k, _: ~k.isin("BX", "RX", "MI", "HP", "PS", "PC")).alias("tags"),
    )


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text, all records, mapped or not."""
    return parse_sam(spark.read.text(path).withColumnRenamed("value", "line"))


def sam_line() -> Column:
    """An alignment row (as of :func:`parse_sam`) as SAM text."""
    known = [("bx", "BX", "Z"), ("rx", "RX", "Z"), ("mi", "MI", "i"), ("hp", "HP", "i"), ("ps", "PS", "i"), ("pc", "PC", "i")]
    named = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{tag}:{kind}:"), F.col(c).cast("string"))) for c, tag, kind in known
    ]
    others = F.transform(F.map_entries("tags"), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return F.concat_ws(
        "\t",
        "qname",
        "flag",
        F.coalesce("rname", F.lit("*")),
        F.coalesce(F.col("start") + 1, F.lit(0)),
        "mapq",
        "cigar",
        F.coalesce("mate_rname", F.lit("*")),
        F.coalesce(F.col("mate_start") + 1, F.lit(0)),
        "template_length",
        "sequence",
        "quality",
        *named,
        others,
    )


def unmapped() -> Column:
    """Records without a position."""
    return F.col("rname").isNull()


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Single-sample variants: 0-based ``pos``, genotype, phase set, filters and an INFO map."""
    f = F.col("f")
    fields = split_fields(lines.where(~F.col("line").startswith("#") & (F.col("line") != "")))
    parts = F.struct("f", F.split(f[8], ":").alias("keys"), F.split(f[9], ":").alias("values"))
    rows = fields.select(F.explode(F.array(parts)).alias("_r")).select("_r.f", "_r.keys", "_r.values")
    keys, values = F.col("keys"), F.col("values")

    def sample(name: str) -> Column:
        return F.nullif(F.try_element_at(values, F.array_position(keys, name).cast("int")), F.lit("."))

    def optional(column: Column) -> Column:
        return F.nullif(column, F.lit("."))

    gt = F.when(F.array_position(keys, "GT") > 0, F.element_at(values, F.greatest(F.array_position(keys, "GT"), F.lit(1)).cast("int")))
    numbers = F.transform(F.split(gt, "[|/]"), lambda g: g.try_cast("int"))
    info = F.str_to_map(f[7], F.lit(";"), F.lit("="))
    ps = F.when(F.array_contains(keys, "PS"), sample("PS").try_cast("long"))
    return rows.select(
        f[0].alias("chrom"),
        (f[1].cast("long") - 1).alias("pos"),
        optional(f[2]).alias("id"),
        f[3].alias("ref"),
        F.when(f[4] == ".", F.array().cast("array<string>")).otherwise(F.split(f[4], ",")).alias("alts"),
        optional(f[5]).cast("double").alias("qual"),
        F.when(f[6] == ".", F.array().cast("array<string>")).otherwise(F.split(f[6], ";")).alias("filter"),
        info.alias("info"),
        numbers.alias("gt"),
        (gt.contains("|") & ~gt.contains("/")).alias("phased"),
        ps.alias("ps"),
    )


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Variants of single-sample VCF text."""
    return parse_vcf(spark.read.text(path).withColumnRenamed("value", "line"))


def vcf_contig_lengths(lines: DataFrame) -> DataFrame:
    """(chrom, length) of VCF header contigs that state one."""
    head = lines.where(F.col("line").startswith("##contig="))
    return head.select(
        F.regexp_extract("line", r"ID=([^,>]+)", 1).alias("chrom"),
        F.regexp_extract("line", r"length=(\d+)", 1).try_cast("long").alias("length"),
    ).where("length IS NOT NULL")


def parse_fai(lines: DataFrame) -> DataFrame:
    """(name, length) of a FASTA index; blank lines are skipped."""
    f = F.col("f")
    return split_fields(lines.where(F.trim("line") != "")).select(f[0].alias("name"), f[1].cast("long").alias("length"))


def parse_bed(lines: DataFrame) -> DataFrame:
    """(chrom, start, end) of BED text."""
    f = F.col("f")
    kept = lines.where((F.trim("line") != "") & ~F.col("line").rlike("^(#|track|browser)"))
    return split_fields(kept).select(f[0].alias("chrom"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"))


def parse_sv_calls(lines: DataFrame) -> DataFrame:
    """Structural variant calls of a ten-column table whose header starts with Chr1."""
    f = F.col("f")
    rows = split_fields(lines.where(~F.col("line").startswith("Chr1") & (F.trim("line") != "")), trim=True)
    return rows.select(
        f[0].alias("chr1"),
        f[1].cast("long").alias("break1"),
        f[2].alias("chr2"),
        f[3].cast("long").alias("break2"),
        f[4].cast("double").cast("long").alias("split_molecules"),
        f[5].cast("double").cast("long").alias("discordant_reads"),
        f[6].alias("orientation"),
        f[7].alias("haplotype"),
        f[8].cast("double").alias("score"),
        f[9].alias("filter"),
    )


def parse_gfa_gaps(lines: DataFrame) -> DataFrame:
    """(gid, left, left_orient, right, right_orient, distance) of GFA gap lines."""
    f = F.col("f")
    rows = split_fields(lines.where(F.col("line").startswith("G\t")))

    def bare(i: int) -> Column:
        return F.regexp_extract(f[i], r"^(.*?)[+-]?$", 1)

    return rows.select(
        f[1].alias("gid"),
        bare(2).alias("left"),
        F.right(f[2], F.lit(1)).alias("left_orient"),
        bare(3).alias("right"),
        F.right(f[3], F.lit(1)).alias("right_orient"),
        f[4].cast("long").alias("distance"),
    )


def parse_phase_blocks(lines: DataFrame) -> DataFrame:
    """(snv_span, phased_snvs, length, fragments) of ``BLOCK:`` lines of an assembler's text."""
    words = F.split(F.trim("line"), r"\s+")
    return lines.where(F.col("line").startswith("BLOCK:")).select(
        words[4].cast("long").alias("snv_span"),
        words[6].cast("long").alias("phased_snvs"),
        words[8].cast("long").alias("length"),
        words[10].cast("long").alias("fragments"),
    )
