"""Tabular outputs: molecule tables, merge lists, cluster tables, sectioned statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def molecule_bed(molecules: DataFrame) -> DataFrame:
    """Six BED-like columns; write with :func:`write_bed` for chromosome / start order."""
    info = F.concat(
        F.lit("Reads="), F.col("Reads"), F.lit(";Length="), F.col("Length"), F.lit(";BpCovered="), F.col("BpCovered")
    )
    return molecules.select(
        "Chromosome", "StartPosition", "EndPosition", "MoleculeID", "Barcode", info.alias("Info")
    )


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated text, one file per partition."""
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def write_bed(bed: DataFrame, path: str) -> None:
    """Headerless BED text ordered by chromosome and start (range partitioned, no single sort)."""
    write_tsv(bed.orderBy("Chromosome", "StartPosition"), path, header=False)


def write_merges(labels: DataFrame, path: str) -> None:
    """``old,new`` pairs for every barcode whose label differs from itself."""
    merges = labels.where(F.col("node") != F.col("label")).select("node", "label")
    merges.write.mode("overwrite").csv(path)


def write_clusters(clusters: DataFrame, path: str) -> None:
    """Cluster table text: larger clusters first, ``canonical, size, comma-joined components``."""
    ordered = clusters.orderBy(F.col("size").desc(), "canonical")
    write_tsv(ordered.select("canonical", "size", F.concat_ws(",", "components")), path, header=False)


def metric_table(rows: DataFrame, metrics: list[str], sample: str = "path", metric: str = "parameter", value: str = "value") -> DataFrame:
    """Long (sample, metric, value) rows as one row per sample with the named metric columns."""
    return rows.groupBy(F.col(sample).alias("Sample")).pivot(metric, metrics).agg(F.max(value))


def stats_lines(df: DataFrame, section: str) -> DataFrame:
    """Rows of a statistics table as ``SECTION<TAB>value...`` text lines."""
    return df.select(F.concat_ws("\t", F.lit(section), *[F.col(c).cast("string") for c in df.columns]).alias("line"))


def summary_lines(counters: DataFrame, name: str = "parameter", value: str = "value", width: int = 15) -> DataFrame:
    """Counter table as aligned text: thousands separators, three decimals for fractions."""
    number = F.col(value)
    text = F.when(number == F.floor(number), F.format_number(number, 0)).otherwise(F.format_number(number, 3))
    return counters.select(F.concat(F.rpad(F.col(name), 40, " "), F.lit(" "), F.lpad(text, width, " ")).alias("line"))
