"""Benchmark passages in documents by Wu-Manber search over words.

Symbols are words (hashed), a pattern is a window of item words, and patterns of one length are searched together. A shift table over
hashed blocks of two words says how far a position can be moved before any pattern could end there; most positions are skipped
that way. A block that ends some pattern selects a bucket by its hash; patterns of the bucket whose hash over all their words agrees are
compared with the text word by word. The positions of many pieces of text move in lock step, so the work is done on arrays.

The pattern tables go to the executors in parts of at most ``PART_BYTES`` of item text, one pass over the documents per part, each adding
its findings to the same row: no part's size grows with the benchmark, and no document is shuffled.

Defined cases: a null or empty text has no words and no hits; an item without words has no window; items with equal windows are all found;
items with a null id are searched too, and all of them are one null entry of ``item_ids``;
repeated rows stay; extra columns of the input stay, and result columns win over input columns of the same name; empty tables give empty
results or no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.octets import LOWER, SpanHashes, byte_table, map_slices, spans, text_bytes

WINDOW = 13
MIN_PERCENT = 5
PART_BYTES = 8_000_000
# Text is searched in pieces of this many words that overlap by a pattern, all pieces of a slice in lock step.
PIECE = 512
_TABLE_BITS = 20
# Word bytes after lower-casing: digits, letters, everything beyond ASCII.
_WORD = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

HITS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def words_of(octets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; starts, ends and row bounds of words; a hash of each word."""
    lowered = LOWER[octets]
    starts, ends, bounds = spans(lowered, offsets, _WORD)
    return lowered, starts, ends, bounds, SpanHashes(lowered).of(starts, ends)


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words, by its first word."""
    n = max(len(words) - length + 1, 0)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total = total * np.uint64(0xD1342543DE82EF95) + words[k : k + n]
    return total


def _block_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    both = first * np.uint64(0xC2B2AE3D27D4EB4F) + second
    return ((both ^ (both >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - _TABLE_BITS)


@dataclass
class Searcher:
    """Shift table, buckets and patterns of one pattern length."""

    length: int
    block: int
    shift: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    items: np.ndarray
    texts: list[bytes]


def build_searchers(ids: list[str], texts: list[bytes], window: int = WINDOW) -> list[Searcher]:
    """One searcher for each length of pattern that the items have."""
    found: dict[int, dict[bytes, set[int]]] = {}
    for place, text in enumerate(texts):
        lowered = np.frombuffer(text, dtype=np.uint8)
        data, starts, ends, _, _ = words_of(lowered, np.array([0, len(lowered)]))
        data, starts, ends = data.tobytes(), starts.tolist(), ends.tolist()
        words = [data[s:e] for s, e in zip(starts, ends, strict=True)]
        length = min(window, len(words))
        for k in range(len(words) - length + 1 if words else 0):
            found.setdefault(length, {}).setdefault(b" ".join(words[k : k + length]), set()).add(place)
    return [_build(length, patterns) for length, patterns in sorted(found.items())]


def _build(length: int, patterns: dict[bytes, set[int]]) -> Searcher:
    texts = sorted(patterns)
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    offsets[-1] -= 1
    words = words_of(joined, offsets)[4].reshape(len(texts), length)
    block = min(2, length)
    shift = np.full(1 << _TABLE_BITS, length - block + 1, dtype=np.int16)
    for end in range(block - 1, length):
        slots = _block_hashes(words[:, end - block + 1], words[:, end])
        np.minimum.at(shift, slots, length - 1 - end)
    whole = np.zeros(len(texts), dtype=np.uint64)
    for k in range(length):
        whole = whole * np.uint64(0xD1342543DE82EF95) + words[:, k]
    order = np.argsort(whole, kind="stable")
    texts = [texts[k] for k in order]
    lists = [sorted(patterns[t]) for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    return Searcher(length, block, shift, whole[order], bounds, np.array([i for x in lists for i in x]), texts)


def search(searcher: Searcher, words: np.ndarray, bounds: np.ndarray, equal) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence within a row; ``equal(word, pattern)`` compares the words themselves."""
    m, block = searcher.length, searcher.block
    pieces = np.maximum((np.diff(bounds) - m + PIECE) // PIECE, 0)
    row = np.repeat(np.arange(len(pieces)), pieces)
    begins = bounds[row] + PIECE * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    # Positions are those of the last word of a possible occurrence.
    at = begins + m - 1
    last = np.minimum(begins + PIECE + m - 1, bounds[row + 1])
    candidates = []
    while len(at):
        step = searcher.shift[_block_hashes(words[at - block + 1], words[at])]
        candidates.append(at[step == 0] - m + 1)
        at = at + np.maximum(step, 1)
        going = at < last
        at, last = at[going], last[going]
    if not candidates:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.concatenate(candidates)
    whole = np.zeros(len(first), dtype=np.uint64)
    for k in range(m):
        whole = whole * np.uint64(0xD1342543DE82EF95) + words[first + k]
    low = np.searchsorted(searcher.hashes, whole, side="left")
    high = np.searchsorted(searcher.hashes, whole, side="right")
    chosen = np.flatnonzero(high > low)
    places, patterns = [], []
    for k in chosen.tolist():
        for pattern in range(int(low[k]), int(high[k])):
            if equal(int(first[k]), pattern):
                places.append(int(first[k]))
                patterns.append(pattern)
    return np.array(places, dtype=np.int64), np.array(patterns, dtype=np.int64)


def _found_in(searchers: list[Searcher], ids: list[str], octets: np.ndarray, offsets: np.ndarray):
    """Words per row, merged hit ranges per row, item ids per row."""
    lowered, starts, ends, bounds, words = words_of(octets, offsets)
    data = lowered.tobytes()
    rows = len(offsets) - 1
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    items: list[set[str]] = [set() for _ in range(rows)]
    for searcher in searchers:
        size = searcher.length

        def equal(word: int, pattern: int, searcher=searcher, size=size) -> bool:
            own = zip(starts[word : word + size].tolist(), ends[word : word + size].tolist(), strict=True)
            return b" ".join([data[s:e] for s, e in own]) == searcher.texts[pattern]

        places, patterns = search(searcher, words, bounds, equal)
        owner = np.searchsorted(bounds, places, side="right") - 1
        for place, pattern, row in zip(places.tolist(), patterns.tolist(), owner.tolist(), strict=True):
            begin = place - int(bounds[row])
            ranges[row].append((begin, begin + size))
            items[row].update(ids[i] for i in searcher.items[searcher.bounds[pattern] : searcher.bounds[pattern + 1]].tolist())
    return np.diff(bounds), ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _pass(docs: DataFrame, part: DataFrame, window: int, text: str) -> DataFrame:
    """One pass over the documents with one part of the items; findings are added to those the row has."""
    rows = part.collect()
    ids, texts = [r["id"] for r in rows], [(r["text"] or "").encode() for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast((ids, texts))
    schema = docs.schema
    tables: list = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not tables:
            tables.append(build_searchers(*shared.value, window))
        at = {name: batch.schema.get_field_index(name) for name in (text, "n_words", "hits", "item_ids")}
        n_words, ranges, items = _found_in(tables[0], shared.value[0], *text_bytes(batch.column(at[text])))
        before = [batch.column(at[c]).to_pylist() for c in ("hits", "item_ids")]
        hits = [
            [{"begin": b, "end": e} for b, e in merged([*new, *[(x["begin"], x["end"]) for x in old]])]
            for new, old in zip(ranges, before[0], strict=True)
        ]
        found = [sorted(new.union(old), key=lambda i: (i is None, i or "")) for new, old in zip(items, before[1], strict=True)]
        columns = list(batch.columns)
        columns[at["n_words"]] = pa.array(n_words, type=pa.int64())
        columns[at["hits"]] = pa.array(hits, type=columns[at["hits"]].type)
        columns[at["item_ids"]] = pa.array(found, type=columns[at["item_ids"]].type)
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(map_slices(work, text), schema)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_percent: int = MIN_PERCENT,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (ranges of words), ``item_ids`` (sorted strings, a null last), ``n_hit`` and ``contaminated``."""
    added = ["n_words", "hits", "item_ids", "n_hit", "contaminated"]
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Parts are dealt by hash; a part is expected to hold half the bound.
    parts = 1 if size <= part_bytes else 2 * size // part_bytes + 1
    found = docs.drop(*[c for c in added if c != text]).select(
        "*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(HITS).alias("hits"), F.lit(None).cast("array<string>").alias("item_ids")
    )
    found = found.withColumn("hits", F.coalesce("hits", F.array().cast(HITS))).withColumn(
        "item_ids", F.coalesce("item_ids", F.array().cast("array<string>"))
    )
    for k in range(parts):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k) if parts > 1 else items
        found = _pass(found, part, window, text)
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + (x["end"] - x["begin"]))
    return found.withColumn("n_hit", covered).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words"))
    )
