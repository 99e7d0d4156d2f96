"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort, counts read off equal partitions.

Every word is a pointer to the up to ``max_words`` words that begin there and end within its piece. Sorting the pointers word by word leaves
partitions of equal beginnings, whose sizes are the counts of phrases.

* A slice of texts is sorted at once; what is equal in it becomes one weighted suffix.
* Suffixes are *routed globally by their two leading words*, so a task sees all of a pair and may abandon it, unsorted beyond these words, when it
  weighs less than ``least``. Single words are routed by themselves.
* A pair that fills much of a slice is routed by three words instead, and its main route is told its weight only. Such pairs are known to be
  continued elsewhere, so nothing under them is abandoned before the last sum. The largest route therefore does not grow with the hottest pair.
* Routes are as many as the corpus needs at ``ROUTE_BYTES`` each; suffixes of a route travel as sorted, compressed blocks.

The same sort serves both sides. It treats all partitions of a depth in one round of array operations: a pivot for each, three-way split, then the
equal parts move on to the next word.

Defined cases: a null text is empty; a null language is ``und``; texts of no words, empty tables and languages without candidates give no rows;
very long texts are slices of their own and stay whole; repeated rows count as often as they are met; ties of a score go to the
higher count, then the smaller phrase in UTF-8 byte order; other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.llm.octets import LOWER, SpanHashes, byte_table, mixed, slices, spans, text_bytes
from tagweave.session import checkpointed

MAX_WORDS = 3
LEAST = 10
TOP = 2000
COVERED = 50
SLICE_BYTES = 1_000_000
# Text whose suffixes one route gathers, before equal suffixes of a slice are joined.
ROUTE_BYTES = 2_500_000
# Suffixes held by a task at once; beyond, equal ones are joined (and what is left is held).
HELD_ROWS = 2_000_000
# A pair is routed by three words from this many suffixes in a slice on, or from CROWD times the slice's share of a route.
LEAST_CROWD, CROWD = 8, 2

BREAK = byte_table(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
WORD = ~(byte_table((0x20, 0x20), (0x09, 0x09)) | BREAK)

# What a suffix in a block stands for.
WORD_COUNT, OPEN, CROWDED, SPREAD = 0, 1, 2, 3
_BLOCK = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("kind", pa.int8()), ("weight", pa.int64())])


@dataclass
class Sorted:
    """Pointers in order; ``common[i]`` leading symbols are shared by places i-1 and i; ``left`` marks places of abandoned partitions."""

    order: np.ndarray
    common: np.ndarray
    left: np.ndarray


def multikey_sort(symbols: np.ndarray, weights: np.ndarray | None = None, least: int = 1, known: int = 0) -> Sorted:
    """Order the columns of ``symbols`` (depth x n, 0 ends a suffix) by three-way partitions, depth by depth.

    Equal partitions of ``known`` symbols that weigh less than ``least`` are not sorted further.
    """
    depth, n = symbols.shape
    order = np.arange(n, dtype=np.int32)
    if not n:
        return Sorted(order, np.zeros(0, dtype=np.int8), np.zeros(0, dtype=bool))
    common = np.full(n, depth, dtype=np.int8)
    common[:1] = 0
    left = np.zeros(n, dtype=bool)
    starts, sizes = np.zeros(1, dtype=np.int32), np.full(1, n, dtype=np.int32)
    for d in range(depth):
        done_starts, done_sizes = [starts[sizes < 2]], [sizes[sizes < 2]]
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        while len(starts):
            ends = np.cumsum(sizes, dtype=np.int32)
            base = ends - sizes
            places = np.arange(ends[-1], dtype=np.int32) + np.repeat(starts - base, sizes)
            held = order[places]
            values = symbols[d][held]
            first, middle, last = values[base], values[base + sizes // 2], values[ends - 1]
            pivots = np.maximum(np.minimum(first, middle), np.minimum(np.maximum(first, middle), last))
            pivot = np.repeat(pivots, sizes)
            parts = (values < pivot, values == pivot, values > pivot)
            counts = np.stack([np.add.reduceat(part, base, dtype=np.int32) for part in parts])
            shifts = np.cumsum(counts, axis=0, dtype=np.int32) - counts
            for part, count, shift in zip(parts, counts, shifts, strict=True):
                own = np.cumsum(count, dtype=np.int32) - count
                order[np.arange(count.sum(), dtype=np.int32) + np.repeat(starts + shift - own, count)] = held[part]
            for k in (1, 2):
                # A part that has something before it begins where the symbols differ.
                begins = (starts + shifts[k])[(counts[k] > 0) & (shifts[k] > 0)]
                common[begins] = d
            done_starts.append(starts + shifts[1])
            done_sizes.append(counts[1])
            others = [(starts + shifts[k], counts[k]) for k in (0, 2)]
            starts = np.concatenate([s[c > 1] for s, c in others])
            sizes = np.concatenate([c[c > 1] for _, c in others])
            for s, c in others:
                done_starts.append(s[c == 1])
                done_sizes.append(c[c == 1])
        starts, sizes = np.concatenate(done_starts), np.concatenate(done_sizes)
        if d + 1 == known and least > 1:
            by_place = np.argsort(starts)
            starts, sizes = starts[by_place], sizes[by_place]
            weight = sizes if weights is None else _sums(weights[order[_places(starts, sizes)]], sizes)
            light = weight < least
            left[_places(starts[light], sizes[light])] = True
            starts, sizes = starts[~light], sizes[~light]
        # Ended suffixes are equal to the end.
        going = symbols[d][order[starts]] != 0
        starts, sizes = starts[going], sizes[going]
    return Sorted(order, common, left)


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    base = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - base, sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of the given (positive) sizes."""
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    return np.add.reduceat(values, np.cumsum(sizes) - sizes, dtype=np.int64)


@dataclass
class Words:
    """Words of a slice: their bytes each followed by a blank, where each begins, its row and the place of its piece's end."""

    octets: np.ndarray
    begins: np.ndarray
    row: np.ndarray
    until: np.ndarray
    codes: np.ndarray

    def suffixes(self, depth: int) -> np.ndarray:
        """Codes of the words from every place on, 0 beyond the end of the piece."""
        n = len(self.codes)
        out = np.zeros((depth, n), dtype=np.int32)
        for d in range(min(depth, n)):
            inside = np.arange(d, n) < self.until[: n - d]
            out[d, : n - d] = np.where(inside, self.codes[d:], 0)
        return out

    def shown(self, places: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """Words from the given places on, joined by blanks."""
        starts = self.begins[places]
        sizes = self.begins[places + lengths] - starts - 1
        offsets = np.zeros(len(places) + 1, dtype=np.int32)
        np.cumsum(sizes, out=offsets[1:])
        data = self.octets[_places(starts, sizes)]
        return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(data))


def cut_words(octets: np.ndarray, offsets: np.ndarray) -> Words:
    """Words and pieces of the texts in ``octets`` (row i at offsets[i]:offsets[i + 1])."""
    octets = LOWER[octets]
    starts, ends, bounds = spans(octets, offsets, WORD)
    n = len(starts)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    breaks = np.concatenate(([0], np.cumsum(BREAK[octets])))
    fresh = np.ones(n + 1, dtype=bool)
    if n:
        fresh[1:n] = (breaks[starts[1:]] != breaks[starts[:-1]]) | (row[1:] != row[:-1])
    edges = np.flatnonzero(fresh)
    until = edges[np.searchsorted(edges, np.arange(n), side="right")] if n else np.zeros(0, dtype=np.int64)
    sizes = ends - starts + 1
    begins = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(sizes, out=begins[1:])
    held = np.full(int(begins[-1]), 0x20, dtype=np.uint8)
    letters = np.ones(len(held), dtype=bool)
    letters[begins[1:] - 1] = False
    compact = octets[_places(starts, ends - starts)]
    held[letters] = compact
    plain = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=plain[1:])
    words = pa.StringArray.from_buffers(n, pa.py_buffer(plain), pa.py_buffer(np.ascontiguousarray(compact)))
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    return Words(held, begins, row, until, codes)


def _joined(words: Words, langs: np.ndarray, depth: int) -> tuple[Sorted, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct suffixes of a slice: the sort, their first places in it, how often they are met and their lengths in words."""
    done = multikey_sort(np.concatenate((langs[None, :], words.suffixes(depth))))
    heads = np.flatnonzero(done.common <= depth)
    totals = np.diff(np.append(heads, len(done.order)))
    lengths = np.minimum(words.until[done.order[heads]] - done.order[heads], depth)
    return done, heads, totals, lengths


def _runs(common: np.ndarray, heads: np.ndarray, shared: int) -> np.ndarray:
    """Of the distinct suffixes at ``heads``, those that begin a partition with ``shared`` equal leading symbols."""
    least = np.minimum.reduceat(common, heads) if len(heads) else common[:0]
    return np.flatnonzero(least < shared)


def _route(langs: np.ndarray, words: Words, places: np.ndarray, width: int, routes: int, hashes: np.ndarray) -> np.ndarray:
    """Route of the suffixes at ``places`` by the language and up to ``width`` leading words."""
    key = langs.astype(np.uint64)
    for d in range(width):
        at = np.minimum(places + d, len(hashes) - 1)
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.where(places + d < words.until[places], hashes[at], np.uint64(0)))
    return (key % np.uint64(routes)).astype(np.int64)


def _pack(route: np.ndarray, lang: pa.Array, phrase: pa.Array, kind: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    """One row for each route: its suffixes as a compressed block."""
    order = np.argsort(route, kind="stable")
    route = route[order]
    batch = pa.RecordBatch.from_arrays([lang, phrase, pa.array(kind), pa.array(weight)], schema=_BLOCK).take(pa.array(order))
    edges = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1], [True]))) if len(route) else np.zeros(1, dtype=np.int64)
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    blocks = []
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _BLOCK, options=options) as writer:
            writer.write_batch(batch.slice(begin, end - begin))
        blocks.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(route[edges[:-1]].astype(np.int32)), pa.array(blocks, type=pa.binary())], names=["route", "block"]
    )


def _word_hashes(words: Words) -> np.ndarray:
    """A hash of every word that depends on its bytes only."""
    return SpanHashes(words.octets).of(words.begins[:-1], words.begins[1:] - 1)


def route_slice(batch: pa.RecordBatch, depth: int, routes: int) -> pa.RecordBatch:
    """Weighted suffixes of a slice of (lang, text), as blocks by route."""
    words = cut_words(*text_bytes(batch.column(1)))
    names = batch.column(0).fill_null("und").dictionary_encode()
    codes = names.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    # Language codes differ between slices, so routes take a hash of the name.
    told = np.array([hash_text(x) for x in names.dictionary.to_pylist()], dtype=np.uint64)
    langs = codes[words.row] + 1
    done, heads, weights, lengths = _joined(words, langs, depth)
    places = done.order[heads]
    hashes = _word_hashes(words)
    by_name = told[langs - 1] if len(told) else np.zeros(0, dtype=np.uint64)

    kinds, routed, at, sizes, totals = [], [], [], [], []

    def add(kind: int, which: np.ndarray, size: np.ndarray, total: np.ndarray, width: int) -> None:
        own = places[which]
        kinds.append(np.full(len(own), kind, dtype=np.int8))
        routed.append(_route(by_name[own], words, own, width, routes, hashes))
        at.append(own)
        sizes.append(size)
        totals.append(total)

    if len(heads):
        single = _runs(done.common, heads, 2)
        add(WORD_COUNT, single, np.ones(len(single), dtype=np.int64), _sums(weights, np.diff(np.append(single, len(heads)))), 1)
        pair = _runs(done.common, heads, 3)
        many = np.diff(np.append(pair, len(heads)))
        crowded = (many >= max(LEAST_CROWD, CROWD * len(heads) / routes)) & (lengths[pair] > 1)
        of_crowded = np.repeat(crowded, many)
        ordinary = np.flatnonzero(~of_crowded & (lengths > 1))
        add(OPEN, ordinary, lengths[ordinary], weights[ordinary], 2)
        add(CROWDED, pair[crowded], np.full(int(crowded.sum()), 2), _sums(weights, many)[crowded], 2)
        longer = np.flatnonzero(of_crowded & (lengths > 2))
        add(SPREAD, longer, lengths[longer], weights[longer], 3)
    if not at:
        return _pack(np.zeros(0, dtype=np.int64), pa.array([], pa.string()), pa.array([], pa.string()), np.zeros(0, np.int8), np.zeros(0, np.int64))
    place = np.concatenate(at)
    lang = names.dictionary.take(pa.array(langs[place] - 1))
    return _pack(np.concatenate(routed), lang, words.shown(place, np.concatenate(sizes)), np.concatenate(kinds), np.concatenate(totals))


def hash_text(text: str) -> int:
    """A 64-bit hash of a short string that is the same in every process."""
    value = 0xCBF29CE484222325
    for octet in text.encode():
        value = ((value ^ octet) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return value


def _collapsed(rows: pa.Table) -> pa.Table:
    """Rows with equal suffixes joined."""
    return rows.group_by(["lang", "phrase", "kind"]).aggregate([("weight", "sum")]).rename_columns(_BLOCK.names)


_GRAMS = "lang string, n_words int, phrase string, f long"


def count_route(rows: pa.Table, depth: int, least: int) -> pa.RecordBatch:
    """Counts of the suffixes of one route: all words together (0 words), words, and phrases that may reach ``least``."""
    columns: list[list[pa.Array]] = [[], [], [], []]

    def out(lang: pa.Array, n_words: np.ndarray, phrase: pa.Array, f: np.ndarray) -> None:
        for held, values in zip(columns, (lang, pa.array(n_words.astype(np.int32)), phrase, pa.array(f.astype(np.int64))), strict=True):
            held.append(values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values)

    kind = rows.column("kind").to_numpy()
    for spread in (False, True):
        chosen = rows.filter(pa.array(kind == SPREAD if spread else kind != SPREAD))
        if not chosen.num_rows:
            continue
        chosen = chosen.combine_chunks()
        words = cut_words(*text_bytes(chosen.column("phrase")))
        weights, own_kind = chosen.column("weight").to_numpy(), chosen.column("kind").to_numpy()
        langs = chosen.column("lang").combine_chunks().dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        # Every row is one suffix; its first word is its pointer.
        heads = np.searchsorted(words.row, np.arange(chosen.num_rows))
        lengths = np.diff(np.append(heads, len(words.row)))
        symbols = np.zeros((depth + 1, len(heads)), dtype=np.int32)
        symbols[0] = code
        for d in range(depth):
            has = lengths > d
            symbols[d + 1, has] = words.codes[heads[has] + d]
        names = langs.dictionary

        def emit(first: np.ndarray, size: int, f: np.ndarray, keep: np.ndarray) -> None:
            own = done.order[first[keep]]
            out(names.take(pa.array(code[own] - 1)), np.full(len(own), size), words.shown(heads[own], np.full(len(own), size)), f[keep])

        if not spread:
            counted = own_kind == WORD_COUNT
            only = np.flatnonzero(counted)
            per_lang = np.bincount(code[only] - 1, weights=weights[only], minlength=len(names)).astype(np.int64)
            met = np.flatnonzero(np.bincount(code[only] - 1, minlength=len(names)))
            out(names.take(pa.array(met)), np.zeros(len(met)), pa.array([""] * len(met), pa.string()), per_lang[met])
            done = multikey_sort(symbols[:, only][:2])
            done.order = only[done.order]
            first = np.flatnonzero(done.common < 2)
            f = _sums(weights[done.order], np.diff(np.append(first, len(only))))
            emit(first, 1, f, f >= least)
            rest = np.flatnonzero(~counted)
        else:
            rest = np.arange(len(heads))
        if not len(rest):
            continue
        # A pair's weight is complete here unless it is spread; a longer phrase's too unless its pair is crowded somewhere.
        done = multikey_sort(symbols[:, rest], weights[rest], 1 if spread else least, known=3)
        done.order = rest[done.order]
        common, total = done.common, weights[done.order]
        pair = np.flatnonzero(common < 3)
        pair_of = np.cumsum(common < 3) - 1
        open_pair = np.ones(len(pair), dtype=bool)
        if not spread:
            open_pair = np.add.reduceat(own_kind[done.order] == CROWDED, pair, dtype=np.int64) > 0
            f = _sums(total, np.diff(np.append(pair, len(total))))
            emit(pair, 2, f, f >= least)
        for size in range(3, depth + 1):
            first = np.flatnonzero(common < size + 1)
            # Abandoned partitions are not in order beyond their pair: nothing in them is frequent.
            f = _sums(total, np.diff(np.append(first, len(total))))
            long = lengths[done.order[first]] >= size
            emit(first, size, f, long & ~done.left[first] & ((f >= least) | open_pair[pair_of[first]]))
    if not columns[0]:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int32(), pa.string(), pa.int64())], names=["lang", "n_words", "phrase", "f"])
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["lang", "n_words", "phrase", "f"])


def frequencies(
    docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, route_bytes: int = ROUTE_BYTES
) -> DataFrame:
    """(lang, n_words, phrase, f): phrases of up to ``max_words`` words met ``least`` times; n_words 0 has the number of all words."""
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    octets = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = int(octets // route_bytes) + 1

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            yield route_slice(part, max_words, routes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit, now = [], 0, HELD_ROWS, None
        for batch in batches:
            for own, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own != now and held:
                    yield count_route(pa.concat_tables(held), max_words, least)
                    held, size, limit = [], 0, HELD_ROWS
                now = own
                part = pa.ipc.open_stream(block.as_buffer()).read_all()
                held.append(part)
                size += part.num_rows
                if size > limit:
                    held = [_collapsed(pa.concat_tables(held))]
                    size = held[0].num_rows
                    limit = size + HELD_ROWS
        if held:
            yield count_route(pa.concat_tables(held), max_words, least)

    blocks = texts.mapInArrow(route, "route int, block binary").repartition(F.col("route")).sortWithinPartitions("route")
    counted = blocks.mapInArrow(count, _GRAMS)
    return counted.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f")).where(f"n_words = 0 OR f >= {least}")


def _exact(column):
    return column.cast("decimal(15,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, covered: int = COVERED, **options
) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase's score is that of its weakest cut, ``floor(10**6 * a * a / (l * r))``. Phrases of which ``covered`` percent lie inside one longer phrase
    are left out.
    """
    grams = checkpointed(frequencies(docs, text, lang, max_words, least, **options))
    words = F.split("phrase", " ")
    candidates = grams.where("n_words > 1").select("lang", "n_words", "phrase", words.alias("words"), F.col("f").alias("a"))
    inner = (
        candidates.where("n_words > 2")
        .select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
        .select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
        .select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = lookup(candidates, inner, ["lang", "phrase"]).where(f"longer IS NULL OR 100 * longer < {covered} * a")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first_part"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first_part", "l"), ("rest", "r")):
        table = grams.where("n_words > 0").select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = lookup(cuts, table, ["lang", part])
    # Decimals of 38 digits hold the products exactly for counts below 10**15; the quotient is at most 10**6.
    squared = _exact(F.col("a")) * _exact(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)")
    scored = cuts.withColumn("_top", squared).withColumn("_under", _exact(F.col("l")) * _exact(F.col("r"))).withColumn("score", F.expr("_top div _under"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's phrases are ranked in parts first.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*by)))
    rows = rows.where(F.col("_place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long"))
    sizes = grams.where("n_words = 0").select("lang", F.col("f").alias("n"))
    return lookup(rows.where(F.col("rank") <= top), sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
