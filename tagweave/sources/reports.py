"""Readers of statistics reports. All take numbered lines (path, line_no, line)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.orderstats import ranked_totals
from tagweave.functions.scans import ordered_scan, running_max
from tagweave.operators.statistics import percent_of_total
from tagweave.sources.lines import LINE_WIDTH, carried_section


def snake_name(name: Column) -> Column:
    """Lower case, blanks as underscores."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))


def sample_name(path: Column, suffix: str) -> Column:
    """File name without directory, extension and a known suffix."""
    base = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[A-Za-z]+$", "")
    return F.replace(base, F.lit(suffix), F.lit(""))


def tool_names(lines: DataFrame) -> DataFrame:
    """(path, tool) from the line that announces the summary."""
    heads = lines.where(F.col("line").startswith("STATS SUMMARY"))
    return heads.groupBy("path").agg(
        F.substring_index(F.trim(F.min_by("line", "line_no")), ".", -1).alias("tool")
    )


def parse_run_log(lines: DataFrame) -> DataFrame:
    """(path, parameter, value) of the first block between a ``---`` and a ``===`` line."""
    rule, stop = F.col("line").startswith("---"), F.col("line").startswith("===")
    opened = lines.where(rule).groupBy("path").agg(F.min("line_no").alias("_open"))
    after = lines.join(opened, "path").where(F.col("line_no") > F.col("_open"))
    closed = after.where(stop).groupBy("path").agg(F.min("line_no").alias("_close"))
    body = after.join(closed, "path", "left").where(
        (F.col("_close").isNull() | (F.col("line_no") < F.col("_close"))) & ~rule
    )
    parts = F.filter(F.split(F.trim("line"), "  "), lambda p: p != "")
    return body.where(F.size(parts) == 2).select(
        "path",
        snake_name(parts[0]).alias("parameter"),
        F.replace(F.trim(parts[1]), F.lit(","), F.lit("")).cast("double").alias("value"),
    )


def section_rows(lines: DataFrame, section: str, names: Sequence[str]) -> DataFrame:
    """Rows of one section of a sectioned statistics file, all columns as text."""
    fields = F.split("line", "\t")
    rows = lines.where(F.col("line").startswith(section + "\t"))
    return rows.select("path", "line_no", *[F.trim(fields[i + 1]).alias(name) for i, name in enumerate(names)])


def summary_numbers(lines: DataFrame) -> DataFrame:
    """(path, parameter, value) of the SN section."""
    rows = section_rows(lines, "SN", ["stat", "value"])
    return rows.select("path", snake_name(F.col("stat")).alias("parameter"), F.col("value").cast("double").alias("value"))


def section_percent(lines: DataFrame, section: str) -> DataFrame:
    """(path, bin, percent): counts of a two-column section as share of the file's total."""
    rows = section_rows(lines, section, ["bin", "count"]).select(
        "path", F.col("bin").cast("double").alias("bin"), F.col("count").cast("long").alias("count")
    )
    return percent_of_total(rows, "count", "percent", ["path"]).select("path", "bin", "percent")


def density_percent(lines: DataFrame) -> DataFrame:
    """(path, reads, percent) of the reads-per-barcode section with its density column."""
    rows = section_rows(lines, "RB", ["reads", "barcodes", "total", "density"])
    return rows.select(
        "path", F.col("reads").cast("long").alias("reads"), (100 * F.col("density").cast("double")).alias("percent")
    )


def plot_limit(points: DataFrame, x: str, y: str, threshold: float, least: int) -> DataFrame:
    """One row ``xmax``: the largest tail position over files, at least ``least``."""
    ranked = ranked_totals(points, x, F.col(y), ["path"], descending=False)
    tails = ranked.groupBy("path").agg(
        F.min(F.when(F.col("upto") > F.col("total") * threshold, F.col(x))).alias("tail")
    )
    return tails.agg(F.greatest(F.max("tail").cast("int"), F.lit(least)).alias("xmax"))


def parse_phasing_report(lines: DataFrame) -> DataFrame:
    """(path, chrom, metric, value): sections ``---- name ----``, All outside any; n/a is dropped."""
    header = F.col("line").startswith("-")
    tagged = carried_section(lines, header, F.split("line", " ")[1], "All").where(~header & F.col("line").contains(":"))
    text = F.trim(F.expr("substring(line, instr(line, ':') + 1)"))
    return tagged.select(
        "path",
        F.col("section").alias("chrom"),
        F.substring_index("line", ":", 1).alias("metric"),
        text.alias("_text"),
    ).where("_text <> 'n/a'").select("path", "chrom", "metric", F.col("_text").cast("double").alias("value"))


def parse_curves(lines: DataFrame) -> DataFrame:
    """(path, stat, x, y) of curve text; ``#`` lines are comments."""
    fields = F.split("line", "\t")
    rows = lines.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    return rows.select(
        "path", fields[0].alias("stat"), fields[1].cast("int").alias("x"), fields[2].cast("double").alias("y")
    )


def parse_haplotag_log(lines: DataFrame) -> DataFrame:
    """(path, parameter, value) after the summary line, with the percentage of tagged alignments."""
    mark = F.trim("line") == "== SUMMARY =="
    scanned = ordered_scan(lines, ["path"], "line_no", LINE_WIDTH, _from=running_max(F.when(mark, F.col("line_no"))))
    body = scanned.where(
        F.col("_from").isNotNull() & ~mark & ~F.col("line").startswith("haplotag") & F.col("line").contains(":")
    )
    values = body.select(
        "path",
        F.substring_index("line", ":", 1).alias("parameter"),
        F.trim(F.expr("substring(line, instr(line, ':') + 1)")).cast("double").alias("value"),
    )
    tagged = F.max(F.when(F.col("parameter") == "Alignments that could be tagged", F.col("value")))
    total = F.max(F.when(F.col("parameter") == "Total alignments processed", F.col("value")))
    share = values.groupBy("path").agg(F.try_divide(F.lit(100.0) * tagged, total).alias("value"))
    return values.unionByName(share.select("path", F.lit("% tagged").alias("parameter"), "value"))


PHASING_COUNTS = ("variants", "phased", "heterozygous_variants", "heterozygous_snvs", "phased_snvs")


def read_phasing_stats(spark: SparkSession, path: str) -> DataFrame:
    """(sample, chromosome, counts...) of a tab-separated table of phasing statistics; its header begins with ``#sample``."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path).withColumnRenamed("#sample", "sample")
    return rows.select("sample", "chromosome", *[F.col(c).cast("long").alias(c) for c in PHASING_COUNTS if c in rows.columns])


def phased_snv_share(stats: DataFrame, chromosomes: Sequence[str] | None = None) -> DataFrame:
    """(sample, chromosome, percent_snvs_phased) of per-chromosome phasing statistics, ALL left out."""
    rows = stats.where("chromosome <> 'ALL'")
    if chromosomes:
        rows = rows.where(F.col("chromosome").isin(*chromosomes))
    share = F.try_divide(F.lit(100.0) * F.col("phased_snvs"), F.col("heterozygous_snvs"))
    return rows.select("sample", "chromosome", share.alias("percent_snvs_phased"))


def phased_snv_totals(stats: DataFrame, chromosomes: Sequence[str] | None = None) -> DataFrame:
    """Per sample: share of SNVs phased over the chosen chromosomes (0 without any) and their millions."""
    rows = stats.where("chromosome <> 'ALL'")
    if chromosomes:
        rows = rows.where(F.col("chromosome").isin(*chromosomes))
    return rows.groupBy("sample").agg(
        F.coalesce(F.try_divide(F.lit(100.0) * F.sum("phased_snvs"), F.sum("heterozygous_snvs")), F.lit(0.0)).alias("percent_snvs_phased"),
        (F.sum("heterozygous_snvs") / 1_000_000).alias("million_snvs"),
        (F.sum("phased_snvs") / 1_000_000).alias("million_phased_snvs"),
    )


def genome_rows(stats: DataFrame) -> DataFrame:
    """The ALL row of each sample, or its only row, with percentages of phased SNVs and variants."""
    rows = stats.groupBy("sample").agg(F.count(F.lit(1)).alias("_rows"))
    kept = stats.join(rows, "sample").where((F.col("_rows") == 1) | (F.col("chromosome") == "ALL")).drop("_rows")
    return kept.withColumns({
        "percent_snvs_phased": F.try_divide(F.lit(100.0) * F.col("phased_snvs"), F.col("heterozygous_snvs")),
        "percent_variants_phased": F.try_divide(F.lit(100.0) * F.col("phased"), F.col("heterozygous_variants")),
    })
