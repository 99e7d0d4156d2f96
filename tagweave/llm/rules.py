"""Line-first cleaning: drop failing lines, then reject documents that lose too much of their text.

Every line is judged alone, by three families of rules:

* punctuation: a line of several words that has a mark of its own alphabet in most words (``###``, ``%%%``, ``!!``), or no letter;
* navigation: a line cut by separators such as ``|`` or ``>`` into many short entries;
* boilerplate: a line saying what pages say around their text (cookies, scripts, rights reserved, sharing).

A line equal to an earlier line is removed as well. A document is kept if it passes the base rules and the
removed lines held at most ``MAX_LOST`` of its words.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; an empty table gives an empty one; very long texts
are judged whole; white-space-only lines count for nothing; of equal lines the first stays; repeated rows are judged one by one; extra columns of the input stay, and result columns win over input columns
of the same name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.octets import NOT_SPACE, SpanHashes, byte_table, map_slices, repeated, spans, text_bytes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Largest share of the words that removed lines may hold.
MAX_LOST = 0.5
# A line is navigation if it has this many separators and at least one for every two and a half other words.
MIN_SEPARATORS = 3
# Marks that end or join words so often only in damaged text.
MAX_MARKED = 0.5
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "click here",
    "read more",
    "sign up",
    "log in",
    "subscribe",
    "share this",
)
_BOILERPLATE = re.compile("|".join(BOILERPLATE).encode())
# A boilerplate phrase fails a line of at most this many words; in longer prose it is quoted, not chrome.
BOILERPLATE_WORDS = 12

_SYMBOLS = byte_table(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_SEPARATORS = frozenset((b"|", b">", b"\xc2\xbb", b"\xe2\x80\xba", b"/"))
_ANY_SEPARATOR = re.compile(rb"[|>/]|\xc2\xbb|\xe2\x80\xba")
# Bytes that every mark or separator has one of; 0xBA and 0xBB end the two that are not ASCII.
_MARK_BYTES = byte_table(*[(ord(c), ord(c)) for c in "#*$%&|<>!/"], (0xBA, 0xBB))
_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_NOT_NEWLINE = ~byte_table((0x0A, 0x0A))
_MARKED = re.compile(rb"[#*$%&|<>]{2}|!!")

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "n_lost_words")
FIELDS = T.StructType([T.StructField(name, T.LongType()) for name in _COUNTS])


def line_fails(line: bytes) -> bool:
    """Whether a line with words fails a punctuation, navigation or boilerplate rule."""
    words = line.split()
    if not _LETTER[np.frombuffer(line, dtype=np.uint8)].any():
        return len(words) > 1
    if len(words) <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()):
        return True
    # Most lines have neither separators nor marks; words are looked at one by one only where there are some.
    if _ANY_SEPARATOR.search(line):
        separators = sum(word in _SEPARATORS for word in words)
        if separators >= MIN_SEPARATORS and 5 * separators >= 2 * (len(words) - separators):
            return True
    if len(words) < 3 or not _MARKED.search(line):
        return False
    return sum(bool(_MARKED.search(word)) for word in words) > MAX_MARKED * len(words)


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _earlier(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether an equal one stands before it, and whether there is an equal one at all."""
    any_ = repeated(keys)
    places = np.flatnonzero(any_)
    order = places[np.argsort(keys[places], kind="stable")]
    before = np.zeros(len(keys), dtype=bool)
    before[order[1:]] = keys[order][1:] == keys[order][:-1]
    return before, any_


def measure(octets: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of a slice."""
    rows = len(offsets) - 1
    starts, ends, bounds = spans(octets, offsets, NOT_SPACE)
    hashes = SpanHashes(octets)
    row_of = np.repeat(np.arange(rows), np.diff(bounds))
    first_byte = (octets & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(first_byte)))
    out = {
        "n_words": np.diff(bounds),
        "word_chars": _per_row(chars[ends] - chars[starts], bounds),
        "n_symbols": _per_row(_SYMBOLS[octets].astype(np.int64), offsets),
    }
    salt = np.arange(rows, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    # Windows of three words; the hash of a window also carries its row.
    covered = np.zeros(len(starts) + 3, dtype=np.int64)
    if len(starts) > 2:
        words = hashes.of(starts, ends)
        inside = np.flatnonzero(row_of[2:] == row_of[:-2])
        keys = words[inside] * np.uint64(0xA0761D6478BD642F) + words[inside + 1]
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xE7037ED1A0B428DB) + words[inside + 2] + salt[row_of[inside]]
        hit = inside[repeated(keys)]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + 3, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(covered)[: len(starts)] > 0, bounds)

    # Lines with a word; an empty run between two newlines has none.
    line_starts, line_ends, line_bounds = spans(octets, offsets, _NOT_NEWLINE)
    line_row = np.repeat(np.arange(rows), np.diff(line_bounds))
    first = np.searchsorted(starts, line_starts)
    count = np.searchsorted(starts, line_ends) - first
    worded = count > 0
    keys = hashes.of(line_starts, line_ends) + salt[line_row]
    duplicate = np.zeros(len(line_starts), dtype=bool)
    duplicate[worded] = _earlier(keys[worded])[0]

    def holds(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[octets])))
        return sums[line_ends] > sums[line_starts]

    # No rule can fail a longer line that has a letter and no byte of a mark or separator.
    open_ = np.flatnonzero(worded & ((count <= BOILERPLATE_WORDS) | holds(_MARK_BYTES) | ~holds(_LETTER)))
    data, bad = octets.tobytes(), np.zeros(len(line_starts), dtype=bool)
    bad[open_] = [line_fails(data[s:e]) for s, e in zip(line_starts[open_].tolist(), line_ends[open_].tolist(), strict=True)]
    out["n_dup_lines"] = _per_row(duplicate, line_bounds)
    out["n_bad_lines"] = _per_row(bad, line_bounds)
    out["n_lost_words"] = _per_row(np.where(bad | duplicate, count, 0), line_bounds)
    return out


def judge(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the counts of :data:`FIELDS`, ``base_failed``, ``lost_share`` and ``kept``."""
    added = [*FIELDS.names, "base_failed", "lost_share", "kept"]
    others = docs.drop(*[c for c in added if c != text])
    schema = T.StructType([*others.schema.fields, *FIELDS.fields])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = measure(*text_bytes(batch.column(batch.schema.get_field_index(text))))
        columns = [*batch.columns, *[pa.array(counts[name], type=pa.int64()) for name in FIELDS.names]]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    counted = others.mapInArrow(map_slices(work, text), schema)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        counted.withColumn("base_failed", base)
        .withColumn("lost_share", F.when(F.col("n_words") > 0, F.col("n_lost_words") / F.col("n_words")).otherwise(1.0))
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= max_lost))
    )


def cleaned(text: str) -> str:
    """A text without its failing and repeated lines."""
    seen, kept = set(), []
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            if line in seen or line_fails(line.encode()):
                continue
            seen.add(line)
        kept.append(line)
    return "\n".join(kept)


def clean(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that :func:`judge` keeps, without the failing and repeated lines of their texts; the columns of ``docs``.

    The verdict is on the whole text. A text that loses nothing stays as it is, byte for byte.
    """
    schema = docs.schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = measure(*text_bytes(batch.column(batch.schema.get_field_index(text))))
        words, lost = counts["n_words"], counts["n_lost_words"]
        kept = (words >= MIN_WORDS) & (100 * counts["n_repeat_words"] <= MAX_REPEAT_PERCENT * words) & (lost <= max_lost * words)
        left = batch.filter(pa.array(kept))
        place, lost = left.schema.get_field_index(text), lost[kept]
        columns = list(left.columns)
        if lost.any():
            texts = [cleaned(t) if n else t for t, n in zip(columns[place].to_pylist(), lost.tolist(), strict=True)]
            columns[place] = pa.array(texts, type=columns[place].type)
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(map_slices(work, text), schema)
