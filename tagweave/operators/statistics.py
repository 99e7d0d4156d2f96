"""Molecule, barcode and cluster statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.orderstats import exact_quantiles, n50_inclusive, ranked_totals
from tagweave.functions.skew import lookup
from tagweave.session import checkpointed


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row tables as one row; the later ones enter as scalar subqueries."""
    extra = [other.select(c).scalar().alias(c) for other in others for c in other.columns]
    return first.select("*", *extra)


def molecule_statistics(molecules: DataFrame) -> DataFrame:
    """The fourteen summary numbers of a molecule table (``Barcode, Reads, Length, BpCovered``).

    An optional ``FileNr`` column keeps equal barcodes of different inputs apart.
    """
    files = ["FileNr"] if "FileNr" in molecules.columns else []
    table = checkpointed(molecules.select("Barcode", *files, "Reads", "Length"))
    per_barcode = checkpointed(
        table.groupBy("Barcode", *files).agg(F.count(F.lit(1)).alias("molecules"), F.sum("Length").alias("dna"))
    )
    length = F.col("Length")

    def long_share(limit: int) -> Column:
        return F.try_divide(F.lit(100.0) * F.sum(F.when(length > limit, length).otherwise(0)), F.sum(length))

    main = table.agg(
        F.avg("Reads").alias("mean_reads_per_molecule"),
        F.avg(length).alias("mean_molecule_length"),
        long_share(20_000).alias("dna_over_20_kbp_percent"),
        long_share(100_000).alias("dna_over_100_kbp_percent"),
        F.try_divide(F.sum((length * length).cast("decimal(38,0)")).cast("double"), F.sum(length)).alias(
            "weighted_mean_length"
        ),
    )
    barcodes = per_barcode.agg(
        F.count_distinct("Barcode").alias("barcodes_final"),
        F.avg("molecules").alias("mean_molecule_count"),
        (F.lit(100.0) * F.avg((F.col("molecules") == 1).cast("int"))).alias("single_molecule_droplets_percent"),
        F.avg("dna").alias("mean_dna_per_barcode"),
    )
    return side_by_side(
        main,
        barcodes,
        n50_inclusive(table, "Reads").withColumnRenamed("n50", "n50_reads_per_molecule"),
        exact_quantiles(table, "Reads", {"median_reads_per_molecule": 0.5}),
        exact_quantiles(table, "Length", {"median_molecule_length": 0.5}),
        exact_quantiles(per_barcode, "molecules", {"median_molecule_count": 0.5}),
        exact_quantiles(per_barcode, "dna", {"median_dna_per_barcode": 0.5}),
    )


def molecules_per_barcode(molecules: DataFrame, barcode: str = "Barcode") -> DataFrame:
    """Count of counts: how many barcodes carry how many molecules."""
    per_barcode = molecules.groupBy(barcode).agg(F.count(F.lit(1)).alias("Molecules"))
    return per_barcode.groupBy("Molecules").agg(F.count(F.lit(1)).alias("Count"))


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Six summary numbers of a cluster table (``canonical, size, components``)."""
    main = clusters.agg(
        F.sum(F.size("components")).alias("barcodes_raw"),
        F.count(F.lit(1)).alias("barcodes_corrected"),
        F.count_if(F.col("size") > 3).alias("barcodes_corrected_over_3"),
        F.max("size").alias("maximum_reads_per_barcode"),
        F.avg("size").alias("mean_reads_per_barcode"),
    )
    return side_by_side(main, exact_quantiles(clusters, "size", {"median_reads_per_barcode": 0.5}))


def reads_per_barcode(clusters: DataFrame) -> DataFrame:
    """Reads, number of barcodes with that many, their total and its share of all reads."""
    counts = clusters.groupBy("size").agg(F.count(F.lit(1)).alias("barcodes"))
    rows = counts.withColumn("total", F.col("size") * F.col("barcodes"))
    everything = clusters.agg(F.sum("size")).scalar()
    return rows.select(
        F.col("size").alias("reads"), "barcodes", "total", F.try_divide(F.col("total"), everything).alias("density")
    )


def components_per_barcode(clusters: DataFrame) -> DataFrame:
    """Clusters by number of components."""
    return clusters.groupBy(F.size("components").alias("components")).agg(F.count(F.lit(1)).alias("barcodes"))


def percent_of_total(df: DataFrame, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add 100 * value / total of the keys."""
    keys = list(keys)
    if keys:
        joined = lookup(df, df.groupBy(*keys).agg(F.sum(value).alias("_total")), keys)
    else:
        joined = df.withColumn("_total", df.agg(F.sum(value)).scalar())
    return joined.withColumn(name, F.try_divide(F.lit(100.0) * F.col(value), F.col("_total"))).drop("_total")


def tail_position(df: DataFrame, x: str, y: str, threshold: float = 0.999, keys: Sequence[str] = ()) -> DataFrame:
    """First x, ascending, at which the running share of y exceeds ``threshold``."""
    ranked = ranked_totals(df, x, F.col(y), keys, descending=False)
    return ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("upto") > F.col("total") * F.lit(threshold), F.col(x))).alias("xmax")
    )


def scaled(df: DataFrame, value: str, name: str, above: str = "M", below: str = "k", limit: int = 1_000_000) -> DataFrame:
    """Scale a column to millions when its overall maximum exceeds ``limit``, else to thousands."""
    large = F.col("_top") > limit
    return (
        df.withColumn("_top", df.agg(F.max(value)).scalar())
        .withColumn(name, F.col(value) * F.when(large, F.lit(0.000001)).otherwise(F.lit(0.001)))
        .withColumn(f"{name}_unit", F.when(large, F.lit(above)).otherwise(F.lit(below)))
        .drop("_top")
    )


def value_counts(df: DataFrame, tag: str, values: DataFrame) -> DataFrame:
    """Rows per requested value (column ``value``), zero counts included; NULL tags never match."""
    counts = df.where(F.col(tag).isNotNull()).groupBy(F.col(tag).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return values.select("value").distinct().join(counts, "value", "left").select(
        "value", F.coalesce("count", F.lit(0)).alias("count")
    )


def rows_with_values(df: DataFrame, tag: str, values: DataFrame) -> DataFrame:
    """Rows whose tag is one of the requested values."""
    keyed = values.select(F.col("value").alias("_value")).distinct().withColumn("_wanted_value", F.lit(True))
    found = lookup(df.withColumn("_value", F.col(tag).cast("string")), keyed, "_value")
    return found.where(F.col("_wanted_value")).select(*df.columns)


def counters(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Long table (parameter, value) of conditional row counts from one pass."""
    wide = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    return wide.unpivot([], list(conditions), "parameter", "value")


def chromosome_rank(name: Column) -> Column:
    """Sort key: numbered chromosomes first (X, Y, M as 23, 24, 25), then the rest by name."""
    bare = F.replace(name, F.lit("chr"), F.lit(""))
    number = (
        F.when(bare.rlike("^[0-9]+$"), bare.cast("int"))
        .when(bare == "X", 23)
        .when(bare == "Y", 24)
        .when(bare == "M", 25)
    )
    return F.struct(
        F.when(number.isNotNull(), 0).otherwise(1).alias("group"),
        F.coalesce(number, F.lit(0)).alias("number"),
        F.when(number.isNull(), bare).otherwise(F.lit("")).alias("name"),
    )


def insert_sizes(reads: DataFrame) -> DataFrame:
    """(insert_size, n) of proper pairs, counted at the read with the positive template length; duplicates and secondary records are left out."""
    flag = F.col("flag")
    usable = (flag.bitwiseAND(2) != 0) & (flag.bitwiseAND(1024 + 256 + 2048) == 0) & (F.col("template_length") > 0)
    return reads.where(usable).groupBy(F.col("template_length").cast("long").alias("insert_size")).agg(F.count(F.lit(1)).alias("n"))


def gc_content(reads: DataFrame, sequence: str = "sequence") -> DataFrame:
    """(gc, n): reads by whole percent of G and C among their known bases; reads without any are left out."""
    strong = F.length(F.regexp_replace(sequence, "[^GCgc]", ""))
    known = F.length(F.regexp_replace(sequence, "[^ACGTacgt]", ""))
    percent = F.when(known > 0, F.floor(100 * strong / known).cast("long"))
    return reads.select(percent.alias("gc")).where("gc IS NOT NULL").groupBy("gc").agg(F.count(F.lit(1)).alias("n"))


def longest(rows: DataFrame, value: str, sample: str = "path") -> DataFrame:
    """(sample, longest): the largest value of each sample."""
    return rows.groupBy(sample).agg(F.max(value).alias("longest"))
