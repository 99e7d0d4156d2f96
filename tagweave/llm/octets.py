"""Vectorised helpers over the UTF-8 bytes of a column: word spans, span hashes, bounded slices of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Texts are handled in slices of about this many bytes, so a batch needs bounded memory; one text is never cut.
SLICE_BYTES = 2_000_000
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A lookup table of 256 flags, set within the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# ASCII white space as the words of a text are cut: blank and tab to carriage return.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER_BYTES = LOWER.tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    octets = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return octets[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows so that each slice holds about ``limit`` bytes of text."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        begin, rows = 0, batch.num_rows
        while begin < rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), rows)
            yield batch.slice(begin, end - begin)
            begin = end


def map_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text", limit: int = SLICE_BYTES):
    """A function for ``mapInArrow`` that applies ``work`` to bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, limit):
            made = work(part)
            if made is not None:
                yield made

    return run


def spans(octets: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``wanted`` bytes within each row: starts, ends, and the runs of row i as bounds[i]:bounds[i+1]."""
    inside = wanted[octets]
    n = len(octets)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | fresh[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n+1 powers of the hash base and of its inverse, kept for the next slice."""
    have = _POWERS.get("up")
    if have is None or len(have) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            grown = np.full(size, base, dtype=np.uint64)
            grown[0] = 1
            _POWERS[name] = np.multiply.accumulate(grown)
    return _POWERS["up"], _POWERS["down"]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class SpanHashes:
    """64-bit hashes of any byte span in constant time, from prefix sums of a polynomial modulo 2**64.

    Bytes are first replaced by random 64-bit values, which takes away the structure such sums collide on.
    """

    def __init__(self, octets: np.ndarray, seed: int = 1):
        codes = np.random.Generator(np.random.Philox(seed)).integers(0, 1 << 64, size=256, dtype=np.uint64)
        up, self._down = _powers(len(octets))
        self._sums = np.zeros(len(octets) + 1, dtype=np.uint64)
        np.cumsum(codes[octets] * up[: len(octets)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the spans; the same bytes have the same hash at any place."""
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of every span of ``width`` bytes, by start."""
        n = max(len(self._sums) - width, 0)
        return mixed((self._sums[width:] - self._sums[:n]) * self._down[:n])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key exists elsewhere: values are sorted, and only those met twice are looked up."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the longs Spark holds."""
    return values.view(np.int64)
