"""Contig chunks: the units work on a genome is divided into."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup

Contig = tuple[str, int]


def contig_chunks(contigs: Iterable[Contig], size: int = 20_000_000) -> list[list[Contig]]:
    """Consecutive contigs grouped while they fit into ``size``; larger ones stand alone.

    Works on a genome's contig index, a list of names and lengths.
    """
    chunks: list[list[Contig]] = []
    room = 0
    for contig in contigs:
        if not chunks or contig[1] > room:
            chunks.append([])
            room = size
        chunks[-1].append(contig)
        room -= contig[1]
    return chunks


def chunk_sets(
    contigs: Sequence[Contig], size: int, phased: Sequence[str] | None = None, skip: str | None = None
) -> dict[str, list[list[Contig]]]:
    """Chunks of the nested sets phased, primary and all, and of their differences.

    ``skip`` is a pattern matched at the start of contig names that keeps them out of primary.
    """
    names = [name for name, _ in contigs]
    primary = {n for n in names if skip is None or not re.match(skip, n)}
    to_phase = primary if phased is None else set(phased)
    unknown, outside = to_phase - set(names), to_phase - primary
    if unknown:
        raise ValueError(f"contigs to phase are not in the reference: {sorted(unknown)}")
    if outside:
        raise ValueError(f"contigs to phase are not primary: {sorted(outside)}")

    def grouped(keep) -> list[list[Contig]]:
        return contig_chunks([c for c in contigs if keep(c[0])], size)

    tiers = {
        "phased": grouped(lambda n: n in to_phase),
        "primary_not_phased": grouped(lambda n: n in primary - to_phase),
        "not_primary": grouped(lambda n: n not in primary),
    }
    return {
        **tiers,
        "primary": tiers["phased"] + tiers["primary_not_phased"],
        "not_phased": tiers["primary_not_phased"] + tiers["not_primary"],
        "all": tiers["phased"] + tiers["primary_not_phased"] + tiers["not_primary"],
    }


def chunk_table(spark: SparkSession, chunks: list[list[Contig]]) -> DataFrame:
    """(chunk, contig, length) rows for joining reads to chunks."""
    rows = [(nr, name, length) for nr, chunk in enumerate(chunks) for name, length in chunk]
    return spark.createDataFrame(rows, "chunk int, contig string, length bigint")


def assign_chunks(reads: DataFrame, table: DataFrame) -> DataFrame:
    """Reads with the chunk of their contig (NULL for unmapped reads and unlisted contigs); chunks are whole contigs, so this is a lookup."""
    return lookup(reads, table.select(F.col("contig").alias("rname"), "chunk"), "rname")
