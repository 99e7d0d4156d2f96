"""Alignment of two tokenizers over the same bytes by merge-path partitioning.

Both tokenizers cut the same bytes; merging the sorted ends of their tokens (A and B) gives every overlap: between two successive ends exactly one
token of A and one of B lie over each other, and where both end at once a group is closed. The ends of a slice of documents form two long
sorted arrays. Equal steps along the merge are found by binary searches on the *diagonals* of the merge grid (so many of A and B
together), which cuts the merge into independent pieces of equal work, whatever the lengths of documents. All pieces merge in step with each other
as array operations; each emits its overlaps and the common ends it met, and a running sum over pieces stitches groups that cross a border.

How often an id pair is linked is counted over the corpus: a slice sends one row for each of its different pairs, counts are joined
back to those rows, and a slice gathers the counts of its own pairs only. Token ids of a slice are written once, compressed, and
merged again where they are needed, which costs less than keeping the links.

Tokenizers are read by the driver from the paths given and sent to the executors as bytes; they are never trained here.

Defined cases: texts that are null or empty, or that either tokenizer changes (its joined token bytes differ from blank and text), have no tokens:
zero counts and empty groups. Special tokens within texts are plain text. Very long texts are slices of their own and stay whole; repeated rows
are documents of their own and are counted so; ties for an A id's highest count all count as best; a null id is kept; other columns of the
input are not carried along, whatever their names; empty tables give empty ones.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.octets import slices
from tagweave.session import checkpointed

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 1_500_000
# Steps of a piece; a slice of the usual size has about as many pieces.
WORK = 1024

# How the byte-level vocabulary splits text before merging (fixed by the public format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class is the same in every version of Unicode that the two pattern engines may follow.
_SETTLED = re.compile("[\x00-ɏ‐-‧€]*")


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``diagonals`` elements of the merge of two sorted arrays, where ``a`` goes first on ties."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - 1 - middle, 0, len(b) - 1)])
        low = np.where(taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low


def merge_pieces(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Overlaps of two tokenisations with the given rising ends, whose last ends are equal.

    Returns the A place, the B place and the group of every overlap, in order, and the number of groups.
    """
    total = len(a) + len(b)
    if not total:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, 0
    cuts = np.append(np.arange(0, total, work), total)
    begins = merge_path(a, b, cuts[:-1])
    i, j = begins, cuts[:-1] - begins
    lengths = np.diff(cuts)
    steps, pieces = int(lengths.max()), len(lengths)
    beyond = np.iinfo(np.int64).max
    # A leading and a closing sentinel: the end before the first, and one that is never reached.
    padded_a, padded_b = np.concatenate(([-1], a, [beyond])), np.concatenate((b, [beyond]))
    at_a, at_b = np.zeros((steps, pieces), dtype=np.int32), np.zeros((steps, pieces), dtype=np.int32)
    closes = np.zeros((steps, pieces), dtype=bool)
    for step in range(steps):
        at_a[step], at_b[step] = i, j
        end = padded_b[j]
        first = padded_a[i + 1] <= end
        closes[step] = ~first & (padded_a[i] == end)
        i = i + first
        j = np.minimum(j + ~first, len(b))
        i = np.minimum(i, len(a))
    inside = np.arange(steps)[None, :] < lengths[:, None]
    closes = closes.T & inside
    # Groups begun in earlier pieces: their common ends, summed over pieces.
    met = closes.sum(axis=1)
    group = np.cumsum(closes, axis=1) + (np.cumsum(met) - met)[:, None]
    links = inside & ~closes
    return at_a.T[links].astype(np.int64), at_b.T[links].astype(np.int64), group[links], int(met.sum())


def _byte_alphabet() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """Tokenizer A: a byte-level vocabulary."""

    def __init__(self, model: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._slow = Tokenizer.from_str(model.decode())
        self._slow.encode_special_tokens = True
        spec = json.loads(model)["model"]
        alphabet = _byte_alphabet()
        vocabulary = {k: v for k, v in spec["vocab"].items()}
        self.octets = [b""] * (max(self._slow.get_vocab(with_added_tokens=True).values()) + 1)
        for token, k in vocabulary.items():
            self.octets[k] = bytes(alphabet[c] for c in token)
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["merges"]]
        ids = [vocabulary[m] for m in merged]
        # Where ids rise with the order of merges, a faster library gives the same tokens.
        self._fast = None
        if ids == sorted(ids):
            ranks = {o: k for k, o in enumerate(self.octets) if o}
            self._fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(texts)
        others = []
        for k, text in enumerate(texts):
            if self._fast is not None and _SETTLED.fullmatch(text):
                out[k] = self._fast.encode_ordinary(text)
            else:
                others.append(k)
        if others:
            for k, done in zip(others, self._slow.encode_batch_fast([texts[k] for k in others], add_special_tokens=False), strict=True):
                out[k] = done.ids
        return out


class PieceTokens:
    """Tokenizer B: pieces with byte fallback, which puts a blank before every text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self._model.get_piece_size())
        self.octets = [
            bytes([int(piece[1:-1], 16)]) if self._model.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(self._model.id_to_piece(list(ids)))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(first: bytes, second: bytes) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(first), PieceTokens(second)


class Pair:
    """Both tokenizers, as bytes that Spark sends to every executor once."""

    def __init__(self, spark: SparkSession, byte_bpe: str, piece_bpe: str):
        with open(byte_bpe, "rb") as first, open(piece_bpe, "rb") as second:
            self._sent = spark.sparkContext.broadcast((first.read(), second.read()))

    def load(self) -> tuple[ByteTokens, PieceTokens]:
        return _tokenizers(*self._sent.value)


def encode_texts(texts: list[str | None], first: ByteTokens, second: PieceTokens) -> tuple[list[list[int]], list[list[int]]]:
    """Token ids of every text; none where a text is null or empty or a tokenizer changes its bytes."""
    known = [k for k, text in enumerate(texts) if text]
    a: list[list[int]] = [[] for _ in texts]
    b: list[list[int]] = [[] for _ in texts]
    given = [texts[k] for k in known]
    for k, text, of_a, of_b in zip(known, given, first.encode([" " + t for t in given]), second.encode(given), strict=True):
        octets = b" " + text.encode()
        if b"".join(map(first.octets.__getitem__, of_a)) == octets and b"".join(map(second.octets.__getitem__, of_b)) == octets:
            a[k], b[k] = of_a, of_b
    return a, b


def _packed(lists: list[list[int]]) -> tuple[bytes, bytes]:
    """Lists of ids and their lengths as compressed bytes."""
    flat = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.uint32)
    return _press(flat), _press(np.fromiter(map(len, lists), dtype=np.uint32, count=len(lists)))


def _press(values: np.ndarray) -> bytes:
    # Ids below 65,536 take two bytes.
    narrow = not len(values) or int(values.max()) < 1 << 16
    data = values.astype(np.uint16 if narrow else np.uint32).tobytes()
    head = bytes([narrow]) + len(data).to_bytes(8, "little")
    return head + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unpress(octets: bytes) -> np.ndarray:
    size = int.from_bytes(octets[1:9], "little")
    data = pa.decompress(octets[9:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(data, dtype=np.uint16 if octets[0] else np.uint32).astype(np.int64)


class Slice:
    """Links of the documents of one slice."""

    def __init__(self, row: dict, first: ByteTokens, second: PieceTokens):
        self.a, self.b = _unpress(row["a"]), _unpress(row["b"])
        self.n_a, self.n_b = _unpress(row["n_a"]), _unpress(row["n_b"])
        sizes = [np.fromiter(map(len, t.octets), dtype=np.int64, count=len(t.octets)) for t in (first, second)]
        ends = np.cumsum(sizes[0][self.a]), np.cumsum(sizes[1][self.b])
        self.at_a, self.at_b, self.group, self.n_groups = merge_pieces(*ends)
        self.n = len(self.n_a)
        self.doc_of_a = np.repeat(np.arange(self.n), self.n_a)
        self.doc = self.doc_of_a[self.at_a]
        self.pair = (self.a[self.at_a] << 32) | self.b[self.at_b]

    def pairs(self) -> np.ndarray:
        """The different id pairs of the slice, ascending."""
        ordered = np.sort(self.pair)
        return ordered[np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]]

    def documents(self, pairs: np.ndarray) -> np.ndarray:
        """How many documents hold each of ``pairs``."""
        many = max(len(pairs), 1)
        met = np.sort(self.doc * many + np.searchsorted(pairs, self.pair))
        fresh = np.append(True, met[1:] != met[:-1])[: len(met)]
        return np.bincount(met[fresh] % many, minlength=len(pairs))

    def groups(self, names: tuple[list[str], ...]) -> list[str]:
        """Every document's groups as text; ``names`` shows ids of A within and at the end of a group's A part, then ids of B likewise."""
        of_a = np.zeros(len(self.a), dtype=np.int64)
        of_b = np.zeros(len(self.b), dtype=np.int64)
        of_a[self.at_a], of_b[self.at_b] = self.group, self.group
        # A token of A stands behind its group's forerunners of both kinds; one of B behind its whole A part, too.
        per_a = np.bincount(of_a, minlength=self.n_groups)
        per_b = np.bincount(of_b, minlength=self.n_groups)
        place_a = np.arange(len(self.a)) + (np.cumsum(per_b) - per_b)[of_a]
        place_b = np.arange(len(self.b)) + np.cumsum(per_a)[of_b]
        last_a = np.append(of_a[1:] != of_a[:-1], True)[: len(self.a)]
        last_b = np.append(of_b[1:] != of_b[:-1], True)[: len(self.b)]
        shown = np.empty(len(self.a) + len(self.b), dtype=object)
        tables = [np.array(t, dtype=object) for t in names]
        for place, ids, last, inner, closing in ((place_a, self.a, last_a, *tables[:2]), (place_b, self.b, last_b, *tables[2:])):
            shown[place] = np.where(last, closing[ids], inner[ids])
        parts, edges = shown.tolist(), np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return ["".join(parts[begin:end])[:-1] for begin, end in zip(edges[:-1], edges[1:], strict=True)]


def _names(first: ByteTokens, second: PieceTokens) -> tuple[list[str], ...]:
    tables = []
    for size, closing in ((len(first.octets), "|"), (len(second.octets), ";")):
        tables += [[f"{k}," for k in range(size)], [f"{k}{closing}" for k in range(size)]]
    return tuple(tables)


def _slices_of(docs: DataFrame, key: str, text: str, tokenizers: Pair) -> DataFrame:
    """One row per slice: its ids and its tokens, compressed."""
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType(
        [T.StructField("slice", T.LongType()), T.StructField("keys", T.ArrayType(kept.schema["key"].dataType))]
        + [T.StructField(name, T.BinaryType()) for name in ("a", "n_a", "b", "n_b")]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers.load()
        partition = TaskContext.get().partitionId()
        for k, part in enumerate(slices(batches, "text", SLICE_BYTES)):
            a, b = encode_texts(part.column(1).to_pylist(), first, second)
            keys = part.column(0)
            listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            columns = [pa.array([octets], pa.binary()) for octets in (*_packed(a), *_packed(b))]
            yield pa.RecordBatch.from_arrays([pa.array([(partition << 33) + k]), listed, *columns], names=schema.names)

    return kept.mapInArrow(work, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}


def align(
    docs: DataFrame,
    byte_bpe: str = f"{FOLDER}/{BYTE_BPE}",
    piece_bpe: str = f"{FOLDER}/{PIECE_BPE}",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``groups`` lists the ids of both tokenizers group by group: ``a1,a2|b1;a3|b2,b3``.
    """
    tokenizers = Pair(docs.sparkSession, byte_bpe, piece_bpe)
    held = checkpointed(_slices_of(docs, key, text, tokenizers))

    def slice_of(row: dict) -> Slice:
        return Slice({c: row[c].as_buffer().to_pybytes() for c in ("a", "n_a", "b", "n_b")}, *tokenizers.load())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = slice_of(row)
            pairs = own.pairs()
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(own.documents(pairs))], names=["pair", "docs"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pairs = slice_of(row).pairs()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["slice"].as_py(), dtype=np.int64)), pa.array(pairs)], names=["slice", "pair"])

    counts = checkpointed(held.mapInArrow(count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("count")))
    of_a = F.shiftright("pair", 32).alias("a")
    # At most one row for each id of A: bounded by its vocabulary.
    highest = counts.groupBy(of_a).agg(F.max("count").alias("highest"))
    told = counts.join(F.broadcast(highest), of_a == F.col("a")).select(
        F.col("pair").alias("_pair"), (F.col("count") * 2 + (F.col("count") == F.col("highest")).cast("long")).alias("told")
    )
    # A pair of nearly every slice is a hot key: both sides are plain, so Spark splits it at run time.
    asked = held.mapInArrow(ask, "slice long, pair long")
    known = asked.join(checkpointed(told), F.col("pair") == F.col("_pair")).select("slice", "pair", "told")
    gathered = known.groupBy("slice").agg(F.collect_list(F.struct("pair", "told")).alias("known"))
    joined = held.join(gathered, "slice", "left")
    key_type = held.schema["keys"].dataType.elementType
    counters = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType(
        [T.StructField(key, key_type), *[T.StructField(c, T.LongType()) for c in counters], T.StructField("groups", T.StringType())]
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(*tokenizers.load())
        for row in _rows(batches):
            own = slice_of(row)
            count = best = np.zeros(0, dtype=np.int64)
            if len(own.pair):
                listed = row["known"].values
                pair, told = listed.field("pair").to_numpy(), listed.field("told").to_numpy()
                order = np.argsort(pair)
                # Every pair of the slice is known, once.
                value = told[order][np.searchsorted(pair[order], own.pair)]
                count, best = value >> 1, value & 1
            closing = np.flatnonzero(np.append(own.group[1:] != own.group[:-1], True)[: len(own.group)])
            per_doc = [
                own.n_a,
                own.n_b,
                np.bincount(own.doc[closing], minlength=own.n),
                np.bincount(own.doc, minlength=own.n),
                _sums_by(own.doc, best, own.n),
                _sums_by(own.doc, count, own.n),
            ]
            columns = [row["keys"].values, *[pa.array(c.astype(np.int64)) for c in per_doc], pa.array(own.groups(names), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(finish, schema)


def _sums_by(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of ``values`` by document, whose links are adjacent."""
    sums = np.concatenate(([0], np.cumsum(values)))
    edges = np.searchsorted(doc, np.arange(n + 1))
    return sums[edges[1:]] - sums[edges[:-1]]
