"""Repeated passages: every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else.

Equal strings have equal minimisers: of all short pieces of a string, the one with the smallest hash stands at the same place in every copy.
So strings that share their minimiser's position within a text form *runs*, one row for about 130 bytes, and a string can only
be repeated under an anchor (the minimiser's own hash) that is met twice.

* A run that is met twice as a whole is repeated as a whole.
* Runs under an anchor with several different runs, where shared passages begin and end, are compared byte by byte. They are lined up at their
  anchor and their suffixes are sorted *column-wise*: from the last column to the first, each round inserts one symbol of every
  string, moves it among the suffixes sorted so far (the collection's Burrows-Wheeler order) and updates the common prefixes of neighbours. A
  string is repeated if it shares ``LENGTH`` bytes with a neighbour. Many anchors are sorted in one collection, read in
  sequence from the sorted shuffle files, so a round is a few array operations and memory is bounded by one collection.
* An anchor with more than ``GROUP_LIMIT`` different runs is not gathered in a task: the hashes of its single strings are counted instead.

Rounds over whole documents, as the construction is published, would be as many as the longest document has bytes, each a job over the whole
corpus; lining up at anchors bounds them by ``2 * LENGTH``.

Texts are told by a 64-bit hash and their length; anchors and runs by independent 64-bit hashes of which both must agree.

Defined cases: a null text is an empty one; texts shorter than ``LENGTH`` have nothing to remove; identical texts remove each other whole;
repeated rows are documents of their own; overlapping repeats within one text count; extra columns of the input stay, and result
columns win over input columns of the same name; empty tables give empty ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.octets import SpanHashes, map_slices, signed, slices, text_bytes
from tagweave.session import checkpointed

LENGTH = 400
PIECE = 64
GROUP_LIMIT = 1024
# Strings sorted in one collection.
COLLECTION = 2048
# Bits of a place in a slice; a text has less than 2**31 bytes and is a slice of its own if it is long.
PLACE_BITS = 32

_RUNS = "anchor long, run long, told long, n_bytes int, first int, last int, place int"
_PARTS = "told long, n_bytes int, begin int, end int"


def find_runs(octets: np.ndarray, offsets: np.ndarray, length: int, piece: int) -> dict[str, np.ndarray]:
    """Runs of string starts with one minimiser: hashes, row, first and last start, and the minimiser's place, within the row."""
    names = ("anchor", "run", "row", "first", "last", "place")
    width = length - piece + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.any():
        return {name: np.zeros(0, dtype=np.int64) for name in names}
    hashes = SpanHashes(octets)
    pieces = hashes.rolling(piece)
    # The smallest hash, then the leftmost place: the low bits of a hash give way to its place in the slice. As many in every slice, or
    # copies in slices of different sizes would rank their pieces differently.
    low = np.uint64(PLACE_BITS)
    ranked = (pieces >> low << low) | np.arange(len(pieces), dtype=np.uint64)
    blocks = -(-len(ranked) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(ranked)] = ranked
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(ranked) - width + 1
    smallest = np.minimum(backward[:n], forward[width - 1 : width - 1 + n])
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][row]
    place = (smallest[starts] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    begins = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    first, last = starts[begins], starts[np.concatenate((begins[1:], [len(starts)])) - 1]
    place, row = place[begins], row[begins]
    base = offsets[row]
    found = (pieces[place], hashes.of(first, last + length), row, first - base, last - base, place - base)
    return dict(zip(names, found, strict=True))


def sort_columns(strings: list[bytes], anchors: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Which strings of ``length`` bytes are met again in their group, by (member, start from the leftmost column).

    ``strings`` of one group are adjacent and lined up at their anchors. Columns count from the largest anchor offset.
    """
    m = len(strings)
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=m)
    shift = int(anchors.max()) - anchors
    columns = int((shift + lengths).max())
    # Symbol 0 stands for "no byte": beyond a string's ends nothing is common.
    symbols = np.zeros((columns, m), dtype=np.int64)
    for k, text in enumerate(strings):
        symbols[shift[k] : shift[k] + lengths[k], k] = np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1
    last_start = shift + lengths - length
    again = np.zeros((m, columns), dtype=bool)
    order = np.arange(m)
    # common[i]: bytes shared by the suffixes at places i-1 and i; the sentinel closes the last range.
    common = np.zeros(m + 1, dtype=np.int64)
    lead = groups.astype(np.int64) * 257
    for column in range(columns - 1, -1, -1):
        key = (lead + symbols[column])[order]
        moved = np.argsort(key, kind="stable")
        key = key[moved]
        order = order[moved]
        fresh = np.zeros(m + 1, dtype=np.int64)
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % 257 > 0)) + 1
        if len(same):
            # Suffixes with one symbol keep their order; what they share is one more than the least between their old places.
            ranges = np.column_stack((moved[same - 1] + 1, moved[same] + 1)).ravel()
            fresh[same] = np.minimum(np.minimum.reduceat(common, ranges)[::2] + 1, length)
        common = fresh
        if column + length <= columns:
            full = np.maximum(common[:m], common[1:]) >= length
            members = order[full]
            again[members, column] = (column >= shift[members]) & (column <= last_start[members])
    return again


def _intervals(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the strings whose starts are flagged, one per run of flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [(int(b), int(e) - 1 + length) for b, e in zip(edges[::2], edges[1::2], strict=True)]


def _runs(texts: DataFrame, length: int, piece: int) -> DataFrame:
    """One row per run of every text; ``texts`` has told, n_bytes and text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find_runs(*text_bytes(batch.column(batch.schema.get_field_index("text"))), length, piece)
        own = batch.select(["told", "n_bytes"]).take(pa.array(found["row"]))
        ints = [pa.array(found[c], type=pa.int32()) for c in ("first", "last", "place")]
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(found["anchor"].astype(np.uint64))), pa.array(signed(found["run"].astype(np.uint64))), *own.columns, *ints],
            names=["anchor", "run", "told", "n_bytes", "first", "last", "place"],
        )

    # A byte of text needs about 80 bytes here, so slices are smaller than elsewhere.
    return texts.mapInArrow(map_slices(work, limit=1_000_000), _RUNS)


def _cut(texts: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """``edges`` with the bytes of their runs."""
    wanted = edges.groupBy("told", "n_bytes").agg(
        F.collect_list(F.struct("anchor", "first", "last", "place", "single", "hot")).alias("edges")
    )
    joined = texts.join(wanted, ["told", "n_bytes"]).select("told", "n_bytes", "text", "edges")
    schema = "anchor long, told long, n_bytes int, first int, place int, single boolean, hot boolean, octets binary"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        octets, offsets = text_bytes(batch.column(2))
        data, at = octets.tobytes(), offsets.tolist()
        told, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [
            (e["anchor"], told[k], sizes[k], e["first"], e["place"], e["single"], e["hot"], data[at[k] + e["first"] : at[k] + e["last"] + length])
            for k, own in enumerate(batch.column(3).to_pylist())
            for e in own
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        names = ["anchor", "told", "n_bytes", "first", "place", "single", "hot", "octets"]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return joined.mapInArrow(map_slices(work), schema)


def _sorted_groups(members: DataFrame, length: int, collection: int) -> DataFrame:
    """Repeated ranges of the runs that are met once, found by sorting the runs of each anchor column-wise."""
    names = ["told", "n_bytes", "begin", "end"]

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        anchors = np.array([r[4] - r[3] for r in rows], dtype=np.int64)
        keys = np.array([r[0] for r in rows], dtype=np.int64)
        groups = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1])))
        again = sort_columns([r[6] for r in rows], anchors, groups, length)
        leftmost, out = int(anchors.max()), []
        for k in np.flatnonzero(again.any(axis=1)).tolist():
            _, told, n_bytes, first, place, single, _ = rows[k]
            if single:
                base = place - leftmost
                out += [(told, n_bytes, base + b, base + e) for b, e in _intervals(again[k], length)]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, "octets"):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                # A collection ends between anchors.
                if len(held) >= collection and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    columns = ["anchor", "told", "n_bytes", "first", "place", "single", "octets"]
    ordered = members.select(*columns).repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(run, _PARTS)


def _counted_strings(members: DataFrame, length: int) -> DataFrame:
    """Repeated ranges of the runs that are met once, found by counting hashes of single strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "octets", 100_000):
            octets, offsets = text_bytes(batch.column(batch.schema.get_field_index("octets")))
            counts = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(len(counts)), counts)
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            starts = offsets[:-1][row] + inner
            own = batch.select(["anchor", "told", "n_bytes", "single"]).take(pa.array(row))
            first = batch.column(batch.schema.get_field_index("first")).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array((first[row] + inner).astype(np.int32)), pa.array(signed(SpanHashes(octets).of(starts, starts + length)))],
                names=["anchor", "told", "n_bytes", "single", "begin", "string"],
            )

    strings = members.mapInArrow(run, "anchor long, told long, n_bytes int, single boolean, begin int, string long")
    place = F.struct("told", "n_bytes", "begin")
    met = strings.groupBy("anchor", "string").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    again = checkpointed(met.where("low <> high").select("anchor", "string"))
    return (
        strings.where("single")
        .join(again, ["anchor", "string"])
        .select("told", "n_bytes", "begin", (F.col("begin") + length).alias("end"))
    )


def repeated_ranges(
    docs: DataFrame, text: str = "text", length: int = LENGTH, piece: int = PIECE, limit: int = GROUP_LIMIT, collection: int = COLLECTION
) -> DataFrame:
    """(told, n_bytes, ranges) of every text with repeated bytes; ``told`` is its hash, ranges are (begin, end) and may overlap."""
    own = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(own.alias("text")).select(
        "text", F.xxhash64("text").alias("told"), F.octet_length("text").alias("n_bytes")
    ).where(F.col("n_bytes") >= length)
    runs = _runs(texts, length, piece)
    met = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("low"), F.max("run").alias("high"))
    shared = checkpointed(met.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("several")))
    # Written: the runs under shared anchors, a row per place; the copies of one text are counted, not listed.
    places = checkpointed(
        runs.join(shared, "anchor")
        .groupBy("anchor", "run", "several", "told", "n_bytes", "first", "last", "place")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    place = F.struct("told", "n_bytes", "first", "last", "place")
    distinct = checkpointed(
        places.groupBy("anchor", "run", "several").agg(F.sum("copies").alias("n"), F.min(place).alias("one"))
    )
    whole = places.join(distinct.where("n > 1").select("anchor", "run"), ["anchor", "run"]).select(
        "told", "n_bytes", F.col("first").alias("begin"), (F.col("last") + length).alias("end")
    )
    edges = distinct.where("several").select("anchor", "one.*", (F.col("n") == 1).alias("single"))
    crowded = checkpointed(edges.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("anchor"))
    edges = edges.join(crowded.withColumn("hot", F.lit(True)), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    # Written: the bytes of one representative of every run under an anchor with several.
    members = checkpointed(_cut(texts.dropDuplicates(["told", "n_bytes"]), edges, length))
    parts = whole.unionByName(_sorted_groups(members.where("NOT hot"), length, collection)).unionByName(
        _counted_strings(members.where("hot"), length)
    )
    return parts.distinct().groupBy("told", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("ranges"))


RESULT = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("kept_sha256", T.StringType()),
]


def remove_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``removed`` (maximal byte ranges) and ``kept_sha256`` of the remaining bytes."""
    ranges = checkpointed(repeated_ranges(docs, text, **options)).withColumnsRenamed(
        {"told": "_told", "n_bytes": "_size", "ranges": "_ranges"}
    )
    others = docs.drop(*[f.name for f in RESULT if f.name != text])
    own = F.coalesce(F.col(text), F.lit(""))
    # Both sides of the join are plain shuffles, so the rows of a text that is met very often are split at run time.
    marked = others.withColumns({"_told": F.xxhash64(own), "_size": F.octet_length(own)}).join(ranges, ["_told", "_size"], "left")
    marked = marked.drop("_told", "_size")
    schema, own_columns = T.StructType([*others.schema.fields, *RESULT]), others.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        octets, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        data, at = octets.tobytes(), offsets.tolist()
        removed, digests = [], []
        for k, parts in enumerate(batch.column(batch.schema.get_field_index("_ranges")).to_pylist()):
            spans: list[dict[str, int]] = []
            digest, done = hashlib.sha256(), 0
            for part in parts or ():
                if spans and part["begin"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], part["end"])
                else:
                    spans.append(dict(part))
            for span in spans:
                digest.update(data[at[k] + done : at[k] + span["begin"]])
                done = span["end"]
            digest.update(data[at[k] + done : at[k + 1]])
            removed.append(spans)
            digests.append(digest.hexdigest())
        columns = [batch.column(batch.schema.get_field_index(c)) for c in own_columns]
        added = [
            pa.array(np.diff(offsets)),
            pa.array([sum(s["end"] - s["begin"] for s in spans) for spans in removed], type=pa.int64()),
            pa.array(removed, type=pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            pa.array(digests, type=pa.string()),
        ]
        return pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)

    return marked.mapInArrow(map_slices(work, text), schema)
