"""Near copies by 64-bit fingerprints, found with Golay-code keys and joined into groups without listing all pairs.

A fingerprint is cut in two ways at once. It has four segments of 16 bits; three errors leave at least one of them intact. The other
48 bits form two halves of 24, and three errors leave at least one half with at most one. So a key is (which segment, its 16 bits,
which half, a Golay index of 23 bits of that half): eight keys to look a fingerprint up by, and at most six times as many to be
found under. Fingerprints that meet under a key are verified by counting differing bits.

A key under which many fingerprints meet (a dense cluster of near copies) is not joined pairwise. Its fingerprints are linked through
*balls* instead: two fingerprints differ in at most three bits exactly if some 64-bit value is within one bit of one and two bits of the
other. Each fingerprint is sent to its 65 values at one bit or less and 2016 at two bits; at each value every one is tied to the
smallest that is within one bit. At most 2081 fingerprints can meet at a value, so this is linear and keeps every link's component.

Defined cases: a null, empty or white-space text has fingerprint zero and is linked like any other; identical texts share a
fingerprint and are one vertex, however many they are; repeated rows stay repeated rows; a null id is never a group's smallest unless all are
null; extra columns of the input stay, and result columns win over input columns of the same name; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm import golay
from tagweave.llm.octets import LOWER_BYTES, map_slices, signed, text_bytes
from tagweave.operators.components import connected_components
from tagweave.session import checkpointed

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# Fingerprints under one key beyond which its pairs are found through balls.
DENSE = 64
_STEP = 1 << 16


def fingerprint_of(text: bytes) -> int:
    """The fingerprint of one text: the majority of each bit over the hashes of its word shingles."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    size = min(SHINGLE, len(words))
    begins, stops = starts[: len(words) - size + 1], (starts + lengths)[size - 1 :]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(begins), _STEP):
        places = zip(begins[k : k + _STEP].tolist(), stops[k : k + _STEP].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in places], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a long (the 64 bits, signed)."""
    others = docs.drop(name)
    schema = T.StructType([*others.schema.fields, T.StructField(name, T.LongType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        octets, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        data, at = octets.tobytes(), offsets.tolist()
        found = np.array([fingerprint_of(data[s:e]) for s, e in zip(at, at[1:], strict=False)], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed(found))], names=schema.names)

    return others.mapInArrow(map_slices(work, text), schema)


def keys_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, own) of every distinct key of each fingerprint; ``own`` marks the eight it looks others up by."""
    rows, keys, own = [], [], []
    for segment in range(4):
        low = np.uint64((1 << (16 * segment)) - 1)
        intact = (values >> np.uint64(16 * segment)) & np.uint64(0xFFFF)
        rest = (values & low) | ((values >> np.uint64(16)) & ~low)
        for half in range(2):
            part = ((rest >> np.uint64(24 * half)) & np.uint64((1 << golay.BITS) - 1)).astype(np.int64)
            indices = golay.neighbour_indices(part)
            first = indices[:, :1]
            ordered = np.sort(indices, axis=1)
            fresh = np.ones(ordered.shape, dtype=bool)
            fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            row, place = np.nonzero(fresh)
            index = ordered[row, place]
            head = ((2 * segment + half) << 28) | (intact.astype(np.int64) << 12)
            rows.append(row)
            keys.append(head[row] | index)
            own.append(index == first[row, 0])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(own)


def _keyed(values: DataFrame) -> DataFrame:
    """(fp, key, own) of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                found = batch.column(0).slice(begin, 2048).to_numpy()
                rows, keys, own = keys_of(found.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[rows]), pa.array(keys), pa.array(own)], names=["fp", "key", "own"]
                )

    return values.select("fp").mapInArrow(run, "fp long, key long, own boolean")


def _balls(values: DataFrame) -> DataFrame:
    """(point, fp, near) for every 64-bit value within two bits of each fingerprint; near: within one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = np.uint64(1) << np.arange(64, dtype=np.uint64)
        first, second = np.triu_indices(64, 1)
        flips = np.concatenate((np.zeros(1, dtype=np.uint64), ones, ones[first] ^ ones[second]))
        near = np.arange(len(flips)) < 65
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                found = batch.column(0).slice(begin, 64).to_numpy()
                points = found.view(np.uint64)[:, None] ^ flips[None, :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(points.ravel())),
                        pa.array(np.repeat(found, len(flips))),
                        pa.array(np.tile(near, len(found))),
                    ],
                    names=["point", "fp", "near"],
                )

    return values.select("fp").mapInArrow(run, "point long, fp long, near boolean")


def links(values: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp`` that give the components of "at most three differing bits".

    Every link joins fingerprints that really differ in three bits or fewer, or have a third one within that of both.
    """
    met = _keyed(values).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("lookups"))
    # Most keys are met once; what is left is written, so that both sides of the next join are plain shuffles.
    shared = checkpointed(met.where("n > 1 AND lookups > 0").select("key", (F.col("n") > dense).alias("dense")))
    # Written as well: the fingerprints that meet others at all.
    held = checkpointed(_keyed(values).join(shared, "key"))
    sparse = held.where("NOT dense")
    pairs = (
        sparse.where("own")
        .select("key", F.col("fp").alias("a"))
        .join(sparse.select("key", F.col("fp").alias("b")), "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
        .select("a", "b")
    )
    balls = _balls(held.where("dense").select("fp").distinct())
    # One row per value, with the smallest near fingerprint; a value at which one fingerprint is alone gives no link.
    meeting = balls.groupBy("point").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("centre"), F.collect_set("fp").alias("members")
    )
    stars = (
        meeting.where("centre IS NOT NULL AND size(members) > 1")
        .select(F.explode("members").alias("a"), F.col("centre").alias("b"))
        .where("a <> b")
    )
    return pairs.unionByName(stars).distinct()


def _grouped(prints: DataFrame, id_column: str, name: str) -> DataFrame:
    """``prints`` with ``root`` (a fingerprint naming the group) and ``component_id``."""
    prints = checkpointed(prints.drop("component_id", "root"))
    classes = checkpointed(prints.groupBy(F.col(name).alias("fp")).agg(F.min(id_column).alias("first")))
    labels = connected_components(links(classes), "a", "b").withColumnRenamed("node", "fp")
    rooted = checkpointed(classes.join(labels, "fp", "left").withColumn("root", F.coalesce("label", "fp")))
    # Written, so that the rows of one very large group are split in the next join.
    smallest = checkpointed(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    table = checkpointed(rooted.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"))
    # Both sides are written tables, so a fingerprint shared by very many rows is split at run time.
    return prints.join(table, prints[name] == table["fp"]).select(*prints.columns, "root", "component_id")


def group(prints: DataFrame, id_column: str = "doc_id", name: str = "fingerprint") -> DataFrame:
    """``prints`` with ``component_id``: the smallest id among all rows reachable over links."""
    return _grouped(prints, id_column, name).drop("root")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hexadecimal digits, component_id) of every row."""
    prints = fingerprints(docs.select(id_column, text), text).drop(text)
    return group(prints, id_column).withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per group: the one with the smallest id (nulls last), then the smallest hash of its text.

    The row is told by its id and text hash, so texts are shuffled once and rows repeated with both are dropped but one.
    """
    prints = fingerprints(docs.select(id_column, text, F.xxhash64(text).alias("_text")), text).drop(text)
    found = _grouped(prints, id_column, "fingerprint")
    first = F.min(F.struct(F.col(id_column).isNull().alias("no"), F.col(id_column).alias("id"), F.col("_text").alias("text")))
    chosen = found.groupBy("root").agg(first.alias("row"))

    def told(row_id, row_text):
        # A null id is told from every text an id may have.
        return F.concat_ws(":", F.coalesce(F.concat(F.lit("="), row_id.cast("string")), F.lit("-")), row_text.cast("string"))

    keep = checkpointed(chosen.select(told(F.col("row.id"), F.col("row.text")).alias("_row")).distinct())
    named = docs.withColumn("_row", told(F.col(id_column), F.xxhash64(text)))
    return named.join(keep, "_row").dropDuplicates(["_row"]).select(*docs.columns)
