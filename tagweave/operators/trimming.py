"""Adapters in reads: approximate matching that tolerates substitutions and indels.

Distances are those of edits, free to begin anywhere in the read. A batch of reads is matched at once, position by position, with the columns of the
distance table held as two bit vectors per read (their vertical differences), so a position costs a dozen array operations
whatever the adapter's length, up to 64 bases. A second pass, back from the end that was found, gives where the match begins.

Rules, where several places match: fewest edits, then the leftmost end, then the rightmost beginning (as little as possible is cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.dna import IUPAC

# The handles around a droplet barcode, and the adapter behind short inserts.
LEFT_HANDLE = "CAGTTGATCATCAGCAGGTAATCTGG"
RIGHT_HANDLE = "CATGACCTCTTGGAACTGTCAGATGTGTATAAGAGACAG"
END_ADAPTER = "CTGTCTCTTATACACATCT"
ERROR_RATE = 0.2
MIN_OVERLAP = 3
MAX_SHIFT = 4
BARCODE_LENGTHS = (19, 21)
MIN_INSERT = 25
LONGEST = 64


class Adapter:
    """A pattern of at most 64 IUPAC letters and the edits it may differ by."""

    def __init__(self, letters: str, rate: float = ERROR_RATE):
        if not 0 < len(letters) <= LONGEST:
            raise ValueError(f"adapters have 1 to {LONGEST} letters")
        self.size, self.rate, self.letters = len(letters), rate, letters
        self._forward, self._backward = self._bits(letters), self._bits(letters[::-1])

    @staticmethod
    def _bits(letters: str) -> np.ndarray:
        """For every byte, the places of the pattern that it matches."""
        bits = np.zeros(256, dtype=np.uint64)
        for k, letter in enumerate(letters.upper()):
            for base in IUPAC[letter]:
                for shown in (base, base.lower()):
                    bits[ord(shown)] |= np.uint64(1) << np.uint64(k)
        return bits

    def allowed(self, size: np.ndarray | int) -> np.ndarray:
        """Edits that so many letters may have."""
        return np.floor(np.asarray(size) * self.rate + 1e-9).astype(np.int64)


@dataclass
class Matches:
    """Per read: edits (-1 where nothing matched), begin and end in the read, and matched letters of the adapter."""

    edits: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    size: np.ndarray


_ONE = np.uint64(1)


def _step(equal: np.ndarray, plus: np.ndarray, minus: np.ndarray, carry: np.uint64) -> tuple[np.ndarray, ...]:
    """One column of the distance table: horizontal differences, then new vertical ones."""
    across = (((equal & plus) + plus) ^ plus) | equal
    up, down = minus | ~(across | plus), plus & across
    shifted_up, shifted_down = (up << _ONE) | carry, down << _ONE
    either = equal | minus
    return up, down, shifted_down | ~(either | shifted_up), shifted_up & either


def match(octets: np.ndarray, starts: np.ndarray, sizes: np.ndarray, adapter: Adapter, min_overlap: int | None = None) -> Matches:
    """Best place of the adapter in each read (bytes ``starts`` to ``starts + sizes`` of ``octets``).

    With ``min_overlap`` a beginning of the adapter may also be cut off by the read's end; the longest such is taken where the
    whole adapter matches nowhere.
    """
    n, m = len(starts), adapter.size
    octets = np.append(octets, np.uint8(0))
    plus, minus = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64)
    score = np.full(n, m, dtype=np.int64)
    best, end = np.full(n, m + 1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    last = np.uint64(m - 1)
    # Longer reads stay in front, so a position only touches reads that reach it.
    order = np.argsort(-sizes, kind="stable")
    live = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    sorted_starts = starts[order]
    for j, count in enumerate(live.tolist()):
        equal = adapter._forward[octets[sorted_starts[:count] + j]]
        up, down, plus[:count], minus[:count] = _step(equal, plus[:count], minus[:count], np.uint64(0))
        score[:count] += ((up >> last) & _ONE).astype(np.int64) - ((down >> last) & _ONE).astype(np.int64)
        better = score[:count] < best[:count]
        best[:count][better] = score[:count][better]
        end[:count][better] = j + 1
    size = np.full(n, m, dtype=np.int64)
    found = best <= adapter.allowed(m)
    if min_overlap is not None:
        ordered_sizes = sizes[order]
        for length in range(min_overlap, m):
            mask = np.uint64((1 << length) - 1)
            # The last column's differences add up to the distance of every beginning of the adapter.
            distance = np.bitwise_count(plus & mask).astype(np.int64) - np.bitwise_count(minus & mask).astype(np.int64)
            partial = (best > adapter.allowed(m)) & (distance <= adapter.allowed(length)) & (ordered_sizes > 0)
            size[partial], end[partial] = length, ordered_sizes[partial]
            score[partial] = distance[partial]
            found |= partial
        cut = size < m
        best[cut] = score[cut]
    begin = np.zeros(n, dtype=np.int64)
    rows = np.flatnonzero(found)
    if len(rows):
        begin[rows] = _begins(octets, sorted_starts[rows], end[rows], size[rows], best[rows], adapter)
    out = Matches(*(np.zeros(n, dtype=np.int64) for _ in range(4)))
    out.edits[order], out.begin[order], out.end[order] = np.where(found, best, -1), begin, np.where(found, end, 0)
    out.size[order] = np.where(found, size, 0)
    return out


def _begins(octets: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, edits: np.ndarray, adapter: Adapter) -> np.ndarray:
    """The rightmost beginning of matches of the adapter's first ``sizes`` letters that end at ``ends`` with ``edits``."""
    n = len(starts)
    drop = (adapter.size - sizes).astype(np.uint64)
    plus, minus = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64)
    score, begin = sizes.copy(), np.full(n, -1, dtype=np.int64)
    last = (sizes - 1).astype(np.uint64)
    # An adapter that is no longer than its edits may match nothing.
    begin[score == edits] = ends[score == edits]
    for t in range(int((sizes + edits).max())):
        at = ends - 1 - t
        inside = at >= 0
        equal = adapter._backward[octets[np.where(inside, starts + at, len(octets) - 1)]] >> drop
        up, down, plus, minus = _step(equal, plus, minus, _ONE)
        score = score + ((up >> last) & _ONE).astype(np.int64) - ((down >> last) & _ONE).astype(np.int64)
        fresh = inside & (score == edits) & (begin < 0)
        begin[fresh] = at[fresh]
    return begin


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of an ASCII column, and the starts and sizes of its rows; a null is empty."""
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    octets = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return octets, offsets[:-1], np.diff(offsets)


def _with_columns(rows: DataFrame, names: dict[str, str], work) -> DataFrame:
    """``rows`` with integer columns made by ``work`` from record batches."""
    kept = rows.drop(*names)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.IntegerType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m.astype(np.int32)) for m in made]], names=schema.names)

    return kept.mapInArrow(run, schema)


def find_adapter(reads: DataFrame, adapter: str, sequence: str = "sequence", rate: float = ERROR_RATE, min_overlap: int | None = MIN_OVERLAP) -> DataFrame:
    """``reads`` with ``adapter_edits`` (-1: none), ``adapter_begin``, ``adapter_end`` and ``adapter_size`` of the best match."""
    pattern = Adapter(adapter, rate)

    def work(batch: pa.RecordBatch) -> list[np.ndarray]:
        found = match(*_flat(batch.column(batch.schema.get_field_index(sequence))), pattern, min_overlap)
        return [found.edits, found.begin, found.end, found.size]

    return _with_columns(reads, dict.fromkeys(("adapter_edits", "adapter_begin", "adapter_end", "adapter_size"), ""), work)


def _cut(column: str, begin: Column, size: Column) -> Column:
    return F.substring(F.col(column), begin + 1, F.greatest(size, F.lit(0)))


def trim_end(reads: DataFrame, adapter: str = END_ADAPTER, sequence: str = "sequence", quality: str = "quality", **options) -> DataFrame:
    """``reads`` without the adapter and what follows it, in bases and qualities."""
    found = find_adapter(reads, adapter, sequence, **options)
    kept = F.when(F.col("adapter_edits") >= 0, F.col("adapter_begin")).otherwise(F.length(sequence))
    cut = {c: _cut(c, F.lit(0), kept) for c in (sequence, quality)}
    return found.withColumns(cut).select(*reads.columns)


def find_barcode(
    reads: DataFrame,
    left: str = LEFT_HANDLE,
    right: str = RIGHT_HANDLE,
    sequence: str = "sequence",
    rate: float = ERROR_RATE,
    shift: int = MAX_SHIFT,
    lengths: tuple[int, int] = BARCODE_LENGTHS,
) -> DataFrame:
    """``reads`` with ``barcode`` and ``insert_begin``, NULL where the handles are not found around it.

    The left handle begins within the first ``shift`` bases; the right one follows a barcode of ``lengths`` bases at most. A barcode
    has that many bases, none of them N.
    """
    one, two = Adapter(left, rate), Adapter(right, rate)

    def work(batch: pa.RecordBatch) -> list[np.ndarray]:
        octets, starts, sizes = _flat(batch.column(batch.schema.get_field_index(sequence)))
        first = match(octets, starts, np.minimum(sizes, one.size + shift + int(one.allowed(one.size))), one)
        ok = (first.edits >= 0) & (first.begin <= shift)
        begin = np.where(ok, first.end, 0)
        rest = np.where(ok, np.minimum(sizes - begin, lengths[1] + two.size + int(two.allowed(two.size))), 0)
        second = match(octets, starts + begin, rest, two)
        ok &= second.edits >= 0
        return [np.where(ok, begin, -1), np.where(ok, begin + second.begin, -1), np.where(ok, begin + second.end, -1)]

    found = _with_columns(reads, dict.fromkeys(("_begin", "_end", "_insert"), ""), work)
    barcode = F.upper(_cut(sequence, F.col("_begin"), F.col("_end") - F.col("_begin")))
    size = F.col("_end") - F.col("_begin")
    good = (F.col("_begin") >= 0) & size.between(*lengths) & ~barcode.contains("N")
    told = {"barcode": F.when(good, barcode), "insert_begin": F.when(F.col("_begin") >= 0, F.col("_insert"))}
    return found.withColumns(told).select(*[c for c in reads.columns if c not in told], *told)


def trim_pairs(
    pairs: DataFrame, left: str = LEFT_HANDLE, right: str = RIGHT_HANDLE, end: str = END_ADAPTER, rate: float = ERROR_RATE, min_insert: int = MIN_INSERT
) -> DataFrame:
    """Read pairs (``r1_seq, r1_qual, r2_seq, r2_qual``) without handles and adapters, and their ``barcode`` (NULL: none valid).

    A first read without handles is left whole, as its end adapter is only looked for behind them; pairs with a mate of fewer than
    ``min_insert`` bases go.
    """
    found = find_barcode(pairs, left, right, "r1_seq", rate)
    front = found.withColumns({c: F.expr(f"substring({c}, coalesce(insert_begin, 0) + 1)") for c in ("r1_seq", "r1_qual")})
    placed = find_adapter(front, end, "r1_seq", rate)
    kept = F.when(F.col("insert_begin").isNotNull() & (F.col("adapter_edits") >= 0), F.col("adapter_begin")).otherwise(F.length("r1_seq"))
    one = placed.withColumns({c: _cut(c, F.lit(0), kept) for c in ("r1_seq", "r1_qual")}).select(*found.columns)
    both = trim_end(one, end, "r2_seq", "r2_qual", rate=rate)
    return both.where((F.length("r1_seq") >= min_insert) & (F.length("r2_seq") >= min_insert)).drop("insert_begin")
