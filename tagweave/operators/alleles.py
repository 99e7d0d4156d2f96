"""Alleles that reads show at variant sites: read bases projected through their CIGAR.

Sites are gathered by bins of ``SITE_WIDTH`` positions, and by narrower ones for shorter reads, so a read meets the sites it may cover in a lookup of
its bins (one row each), whatever the depth, and few others; no read is paired with another read or with sites it does not reach. Projection is done for a batch of reads at once: operations of
all CIGARs are laid end to end, and the place of a site in a read is a binary search among aligned stretches, so long reads with
thousands of operations cost no more per operation than short ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.skew import lookup
from tagweave.operators.variants import alleles, heterozygous

SITE_WIDTH = 1 << 10
# A read takes the narrowest bins that are no shorter than itself; each width costs one more copy of the sites.
NARROWER = (1 << 6, 1 << 8)
# Quality of bases of reads that carry none.
UNKNOWN_QUALITY = 20
UNMAPPED, SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 4, 256, 512, 1024, 2048
SKIPPED_FLAGS = UNMAPPED | SECONDARY | FAILED | DUPLICATE | SUPPLEMENTARY

_OPERATION = re.compile("([0-9]+)([MIDNSHP=X])")


def votes(min_mapq: int = 0) -> Column:
    """Mapped primary alignments that passed and are no duplicates, confident enough."""
    return (F.col("flag").bitwiseAND(SKIPPED_FLAGS) == 0) & (F.col("mapq") >= min_mapq)


def variant_sites(variants: DataFrame, indels: bool = False, phased: bool = True) -> DataFrame:
    """(chrom, pos, ps, span, first, second, zero) of heterozygous variants: their alleles in the order of the genotype, and the bases replaced.

    ``zero`` is the allele number of the first, 0 for the smaller of the genotype's numbers.

    Several records at a place stay several sites. With ``phased`` only variants of a phase set are taken.
    """
    chosen = variants.where(heterozygous(indels))
    if phased:
        chosen = chosen.where(F.col("phased") & F.col("ps").isNotNull())
    kept = [c for c in ("idx",) if c in variants.columns]
    return chosen.select(
        "chrom",
        "pos",
        "ps",
        F.length("ref").alias("span"),
        F.upper(F.element_at(alleles(), F.element_at("gt", 1) + 1)).alias("first"),
        F.upper(F.element_at(alleles(), F.element_at("gt", 2) + 1)).alias("second"),
        F.when(F.element_at("gt", 1) < F.element_at("gt", 2), 0).otherwise(1).alias("zero"),
        *kept,
    )


class Projection:
    """Places of reference positions in reads, for a batch of alignments."""

    def __init__(self, cigars: Sequence[str | None], starts: np.ndarray):
        # Each different CIGAR is read once.
        codes: dict[str | None, int] = {}
        code = np.fromiter((codes.setdefault(c, len(codes)) for c in cigars), dtype=np.int64, count=len(cigars))
        found = [_OPERATION.findall(c) if c else [] for c in codes]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        counts = sizes[code]
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        lengths = np.array([int(n) for ops in found for n, _ in ops], dtype=np.int64)[at]
        kinds = np.frombuffer("".join(k for ops in found for _, k in ops).encode(), dtype=np.uint8)[at]
        row = np.repeat(np.arange(len(code)), counts)
        on_reference = np.where(np.isin(kinds, np.frombuffer(b"MDN=X", dtype=np.uint8)), lengths, 0)
        on_read = np.where(np.isin(kinds, np.frombuffer(b"MIS=X", dtype=np.uint8)), lengths, 0)
        first = np.concatenate(([0], np.cumsum(counts)))[:-1]
        before = [np.cumsum(x) - x for x in (on_reference, on_read)]
        base = [np.append(x, 0)[np.minimum(first, len(x))][row] if len(x) else x for x in before]
        aligned = np.isin(kinds, np.frombuffer(b"M=X", dtype=np.uint8)) & (lengths > 0)
        self._row = row[aligned]
        self._at = (starts[row] + before[0] - base[0])[aligned]
        self._read = (before[1] - base[1])[aligned]
        self._length = lengths[aligned]
        self._wide = int(max(self._at.max(initial=0), starts.max(initial=0))) + (1 << 32)
        self._keys = self._row * self._wide + self._at

    def places(self, rows: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Place in the read of the base aligned to each position, -1 where there is none."""
        if not len(self._keys):
            return np.full(len(rows), -1, dtype=np.int64)
        k = np.searchsorted(self._keys, rows * self._wide + positions, side="right") - 1
        found = (k >= 0) & (self._row[k] == rows)
        offset = positions - self._at[k]
        return np.where(found & (offset < self._length[k]), self._read[k] + offset, -1)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first and end position of every aligned stretch."""
        return self._row, self._at, self._at + self._length


def _octets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an ASCII column and the offsets of its rows; a null is empty."""
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1)
    data = column.buffers()[2] if len(column) else None
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), offsets.astype(np.int64)


_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[0x61:0x7B] -= 32


@dataclass
class Sites:
    """Sites of a batch of reads: how many each read has, and flat arrays of their places and spans.

    ``single`` marks one base against one base, where what follows does not matter.
    """

    counts: np.ndarray
    pos: np.ndarray
    span: np.ndarray
    single: np.ndarray


def project(cigars: list, starts: np.ndarray, sequences: pa.Array, qualities: pa.Array, sites: Sites) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Row, place among ``sites``, bases shown and least base quality for every site that a read covers.

    A site of one base shows the base aligned to it. Of others, both the first base and the one behind the last must be aligned; what lies between
    in the read is shown, so inserted bases are part of it.
    """
    rows = np.repeat(np.arange(len(sites.counts)), sites.counts)
    projection = Projection(cigars, starts)
    begin = projection.places(rows, sites.pos)
    end = np.where(sites.single, begin + 1, projection.places(rows, sites.pos + sites.span))
    (bases, base_at), (marks, mark_at) = _octets(sequences), _octets(qualities)
    sizes = np.diff(base_at)
    found = np.flatnonzero((begin >= 0) & (end > begin) & (end <= sizes[rows])) if len(rows) else np.zeros(0, dtype=np.int64)
    rows, begin, length = rows[found], begin[found], (end - begin)[found]
    offsets = np.concatenate(([0], np.cumsum(length)))
    inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length)
    shown = _UPPER[bases[np.repeat(base_at[rows] + begin, length) + inner]]
    told = (np.diff(mark_at) == sizes)[rows]
    at = np.where(np.repeat(told, length), np.repeat(mark_at[rows] + begin, length) + inner, 0)
    values = marks[np.minimum(at, max(len(marks) - 1, 0))].astype(np.int64) - 33 if len(marks) else np.zeros(len(at), dtype=np.int64)
    least = np.minimum.reduceat(values, offsets[:-1]) if len(found) else values
    seen = pa.StringArray.from_buffers(len(found), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(shown)))
    return rows, found, seen, np.where(told, least, UNKNOWN_QUALITY)


def _spread(rows: DataFrame, first: Column, last: Column, width: int) -> DataFrame:
    """One row per bin from ``first`` to ``last``, of the width that fits the row's length: ``_width, _bin``."""
    fits = F.lit(width)
    for narrower in sorted((n for n in NARROWER if n < width), reverse=True):
        fits = F.when(last - first < narrower, F.lit(narrower)).otherwise(fits)
    placed = rows.withColumn("_width", fits.cast("int"))
    bins = F.sequence(F.floor(first / F.col("_width")), F.floor(last / F.col("_width")))
    return placed.withColumn("_bin", F.explode(bins))


def _record(told: Sequence[str]) -> np.dtype:
    """A site as bytes: its numbers, which of them are unknown (a bit each), and the sizes of its two alleles."""
    return np.dtype([*[(c, "<i8") for c in told], ("span", "<i8"), ("unknown", "<i4"), ("single", "<i4"), ("first", "<i4"), ("second", "<i4")])


def _packed_sites(binned: DataFrame, told: Sequence[str]) -> DataFrame:
    """``_sites`` of every bin as ``_numbers``, records of a fixed size in order of place, and ``_bases``, both alleles of each laid end to end."""
    record, keys = _record(told), [c for c in binned.columns if c != "_sites"]
    schema = T.StructType([*[binned.schema[c] for c in keys], T.StructField("_numbers", T.BinaryType()), T.StructField("_bases", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keys))
            flat = lists.flatten()
            records = np.zeros(len(flat), dtype=record)
            for k, c in enumerate((*told, "span")):
                field = flat.field(c)
                records[c] = field.fill_null(0).to_numpy(zero_copy_only=False)
                records["unknown"] |= field.is_null().to_numpy(zero_copy_only=False).astype(np.int32) << k
            both = [flat.field(c).cast(pa.string()).fill_null("") for c in ("first", "second")]
            for c, texts in zip(("first", "second"), both):
                records[c] = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            short = [pc.equal(pc.utf8_length(texts), 1).to_numpy(zero_copy_only=False) for texts in both]
            records["single"] = (records["span"] == 1) & short[0] & short[1]
            joined = pc.binary_join_element_wise(*both, "").to_pylist()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
            spans = list(zip([0, *ends], ends))
            numbers = pa.array([records[i:j].tobytes() for i, j in spans], pa.binary())
            bases = pa.array(["".join(joined[i:j]).encode() for i, j in spans], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keys))], numbers, bases], names=schema.names)

    return binned.select(*keys, "_sites").mapInArrow(work, schema)


def _met_sites(held: dict[str, pa.Array], record: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The sites of all bins of a batch, each bin once: their records and their alleles (first and second in turn); and which of them each
    read spans: the first, and how many."""
    _, at, of = np.unique(held["_id"].to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
    at = pa.array(at)
    numbers, bases = (held[c].take(at) for c in ("_numbers", "_bases"))
    records = np.frombuffer(b"".join(numbers.to_pylist()), dtype=record)
    sizes = pc.binary_length(numbers).to_numpy(zero_copy_only=False).astype(np.int64) // record.itemsize
    ends = np.cumsum(np.stack([records["first"], records["second"]], axis=1).ravel(), dtype=np.int64)
    alleles_ = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(b"".join(bases.to_pylist()) or b" "))
    starts, stops = (held[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end"))
    # Places from the smallest on, bins one behind the other.
    low = min(records["pos"].min(), starts.min())
    wide = max(records["pos"].max(), stops.max(), starts.max()) - low + 1
    keys = np.repeat(np.arange(len(sizes)), sizes) * wide + (records["pos"] - low)
    first, last = (np.searchsorted(keys, of * wide + (x - low), side="left") for x in (starts, np.maximum(starts, stops)))
    return records, first, last - first, alleles_


def packed_alleles(reads: DataFrame, sites: DataFrame, keep: Sequence[str] = ("qname", "rname", "start", "bx"), width: int = SITE_WIDTH) -> DataFrame:
    """``keep`` columns of every read with ``shown``: the sites of a bin of which it shows an allele, as ``pos, ps, side, quality`` (and ``idx, zero``).

    ``side`` is 0 for the genotype's first allele and 1 for its second; reads without such a site give no row, long ones a row per
    bin. ``reads`` has ``rname, start, end, cigar, sequence, quality`` besides. The sites of a bin go to its reads as bytes, which are
    opened once for all reads of a batch.
    """
    told = [c for c in ("pos", "ps", "idx", "zero") if c in sites.columns]
    fields = ["pos", *[c for c in (*told[1:], "span", "first", "second") if c in sites.columns]]
    widths = F.array(*[F.lit(n).cast("int") for n in (*[n for n in NARROWER if n < width], width)])
    binned = (
        sites.withColumn("_width", F.explode(widths))
        .groupBy(F.col("chrom").alias("rname"), "_width", F.floor(F.col("pos") / F.col("_width")).alias("_bin"))
        # At most the records of ``width`` positions.
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_sites"))
        .where("rname IS NOT NULL AND _bin IS NOT NULL")
    )
    own = ["cigar", "sequence", "quality", "start", "end"]
    columns = list(dict.fromkeys([*keep, "rname", *own]))
    chosen = reads.where("cigar IS NOT NULL AND sequence IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").select(*columns)
    spread = _spread(chosen, F.col("start"), F.greatest("start", F.col("end") - 1), width)
    table = _packed_sites(binned, told).withColumn("_id", F.monotonically_increasing_id())
    met = lookup(spread, table, ["rname", "_width", "_bin"]).where("_id IS NOT NULL").select(*columns, "_numbers", "_bases", "_id")
    record = _record(told)
    shown = T.StructType([*[sites.schema[c] for c in told], T.StructField("side", T.IntegerType()), T.StructField("quality", T.IntegerType())])
    kinds = {c: pa.int32() if isinstance(sites.schema[c].dataType, T.IntegerType) else pa.int64() for c in told}
    schema = T.StructType([*[met.schema[c] for c in keep], T.StructField("shown", T.ArrayType(shown))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            records, first, counts, both = _met_sites(held, record)
            some = np.flatnonzero(counts)
            if len(some) < len(counts):
                held = {name: held[name].take(pa.array(some)) for name in columns}
                first, counts = first[some], counts[some]
            starts = held["start"].to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            own = Sites(counts, records["pos"][at], records["span"][at], records["single"][at].astype(bool))
            rows, picked, seen, least = project(held["cigar"].to_pylist(), starts, held["sequence"], held["quality"], own)
            site, seen = at[picked], seen.cast(pa.large_string())
            one, two = (pc.equal(seen, both.take(pa.array(site * 2 + k))).to_numpy(zero_copy_only=False) for k in (0, 1))
            of = np.flatnonzero(one | two)
            sizes = np.bincount(rows[of], minlength=len(counts))
            values = records[site[of]]
            parts = [pa.array(values[c], mask=(values["unknown"] >> k & 1).astype(bool)).cast(kinds[c]) for k, c in enumerate(told)]
            parts += [pa.array(np.where(one, 0, 1)[of].astype(np.int32)), pa.array(least[of].astype(np.int32))]
            some = np.flatnonzero(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes[some]))).astype(np.int32)), pa.StructArray.from_arrays(parts, names=shown.names))
            yield pa.RecordBatch.from_arrays([*[held[c].take(pa.array(some)) for c in keep], lists], names=schema.names)

    return met.mapInArrow(work, schema)


def unpacked(packed: DataFrame) -> DataFrame:
    """One row per site of ``shown``, its fields as columns."""
    others = [c for c in packed.columns if c != "shown"]
    return packed.select(*others, F.inline("shown"))


def observed_alleles(reads: DataFrame, sites: DataFrame, keep: Sequence[str] = ("qname", "rname", "start", "bx"), width: int = SITE_WIDTH) -> DataFrame:
    """The rows of :func:`packed_alleles`, one per site: ``keep`` columns, ``pos, ps, side, quality`` (and ``idx, zero``)."""
    return unpacked(packed_alleles(reads, sites, keep, width))


def aligned_blocks(reads: DataFrame, keep: Sequence[str] = ("qname", "rname")) -> DataFrame:
    """``keep`` columns with ``start`` and ``end`` of every stretch of aligned bases; deletions, skips and clips are in none."""
    rows = reads.where("cigar IS NOT NULL AND start IS NOT NULL").select(*keep, F.col("start").alias("_start"), "cigar")
    kept = [rows.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(len(keep)).to_numpy(zero_copy_only=False).astype(np.int64)
            row, start, end = Projection(batch.column(len(keep) + 1).to_pylist(), starts).blocks()
            own = [batch.column(k).take(pa.array(row)) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(start), pa.array(end)], names=schema.names)

    return rows.mapInArrow(work, schema)
