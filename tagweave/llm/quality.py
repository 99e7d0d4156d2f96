"""Document quality by a linear-chain conditional random field that labels every line good or bad.

A line is described by numbers (length, word lengths, marks, capitals, repetition within the line and the document, ...), each cut into
bins at quantiles of the training lines. The field scores a line by its own bins and by those of the lines before and after it, with learned
transitions between labels. A document's quality is the mean of its lines' forward-backward probabilities of "good", weighted by
their words, put on the scale of the labels by a logistic curve.

Training uses at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id, with texts of at most ``TRAIN_CHARS`` characters; their
lines carry the document's label. Scores are computed from whole texts only.

Defined cases: a null, empty or white-space text has no line and gets the share of good training rows; labels with a null id or quality
are not used; without training rows, or with one label only, every score is that share, or 0.5; repeated rows are scored alike; extra columns of the
input stay, and result columns win over input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.crf import Ascent, Chain, layout, marginals
from tagweave.llm.octets import NOT_SPACE, SpanHashes, byte_table, map_slices, repeated, spans, text_bytes

TRAIN_ROWS = 2000
TRAIN_CHARS = 20_000
BINS = 8
ROUNDS = 80

_UPPER, _LOWER = byte_table((0x41, 0x5A)), byte_table((0x61, 0x7A))
_DIGIT, _WIDE = byte_table((0x30, 0x39)), byte_table((0x80, 0xFF))
_STOP = byte_table(*[(ord(c), ord(c)) for c in ".!?:;\"')"])
_PUNCTUATION = byte_table(*[(ord(c), ord(c)) for c in ".,;:!?'\"()-"])
_SYMBOL = byte_table(*[(ord(c), ord(c)) for c in "#*$%&|<>@^~_=+[]{}\\/"])
_NOT_NEWLINE = ~byte_table((0x0A, 0x0A))


@dataclass
class Lines:
    """Lines with words: their document, words and numbers."""

    row: np.ndarray
    words: np.ndarray
    numbers: np.ndarray


@dataclass
class Model:
    """Bin edges by number; weights by (neighbour, number, bin, label); chain; logistic curve."""

    edges: np.ndarray
    weights: np.ndarray
    chain: Chain
    slope: float
    offset: float
    prior: float


def read_lines(octets: np.ndarray, offsets: np.ndarray) -> Lines:
    """The lines of a slice that have a word, with their numbers."""
    starts, ends, _ = spans(octets, offsets, NOT_SPACE)
    line_starts, line_ends, line_bounds = spans(octets, offsets, _NOT_NEWLINE)
    first = np.searchsorted(starts, line_starts)
    count = np.searchsorted(starts, line_ends) - first
    row = np.repeat(np.arange(len(line_bounds) - 1), np.diff(line_bounds))
    used = count > 0
    line_starts, line_ends, first, count, row = line_starts[used], line_ends[used], first[used], count[used], row[used]
    lines = len(count)
    if not lines:
        return Lines(row, count, np.zeros((0, 15)))
    hashes = SpanHashes(octets)
    line_of_word = np.repeat(np.arange(lines), count)
    sizes = (ends - starts).astype(np.float64)
    total_bytes = np.bincount(line_of_word, weights=sizes, minlength=lines)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[octets])))
        return (sums[line_ends] - sums[line_starts]) / np.maximum(total_bytes, 1)

    def word_share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line_of_word, weights=flags, minlength=lines) / count

    words = hashes.of(starts, ends)
    document = row[line_of_word].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    in_line = words + line_of_word.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    before = np.zeros(len(words), dtype=bool)
    before[1:] = words[1:] == words[:-1]
    # Pairs of words met again in the document.
    pair = np.zeros(len(words), dtype=np.uint64)
    pair[:-1] = words[:-1] * np.uint64(0xE7037ED1A0B428DB) + words[1:]
    inner = np.zeros(len(words), dtype=bool)
    inner[:-1] = row[line_of_word[1:]] == row[line_of_word[:-1]]
    again = np.zeros(len(words), dtype=bool)
    again[inner] = repeated((pair + document)[inner])
    last = octets[ends - 1]
    letters = share(_UPPER) + share(_LOWER) + share(_WIDE)
    numbers = np.column_stack(
        [
            np.log1p(count),
            total_bytes / count,
            share(_UPPER) / np.maximum(letters, 1e-9),
            share(_DIGIT),
            share(_PUNCTUATION),
            share(_SYMBOL),
            word_share(_SYMBOL[last]),
            word_share((sizes == 1) & _SYMBOL[octets[starts]]),
            word_share(last == ord("!")),
            _STOP[octets[ends[first + count - 1] - 1]],
            _UPPER[octets[starts[first]]] | _WIDE[octets[starts[first]]],
            word_share(repeated(in_line)),
            word_share(before),
            word_share(again),
            repeated(hashes.of(line_starts, line_ends) + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)),
        ]
    ).astype(np.float64)
    return Lines(row, count, numbers)


def _bins(edges: np.ndarray, lines: Lines) -> np.ndarray:
    """Bin of every (neighbour, number) of every line; neighbours beyond the document have a bin of their own."""
    own = np.column_stack([np.searchsorted(edges[k], lines.numbers[:, k], side="right") for k in range(lines.numbers.shape[1])])
    nothing = edges.shape[1] + 1
    out = np.full((3, *own.shape), nothing, dtype=np.int64)
    out[0] = own
    same = lines.row[1:] == lines.row[:-1]
    out[1, 1:][same] = own[:-1][same]
    out[2, :-1][same] = own[1:][same]
    return out


def _scores(model: Model, bins: np.ndarray) -> np.ndarray:
    scores = np.zeros((bins.shape[1], 2))
    for side in range(3):
        for k in range(bins.shape[2]):
            scores += model.weights[side, k, bins[side, :, k]]
    return scores


def _chain_lengths(row: np.ndarray) -> np.ndarray:
    return np.diff(np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True])))) if len(row) else np.zeros(0, dtype=np.int64)


def _good_share(model: Model, lines: Lines, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean probability of "good" of each document, weighted by words, and its words."""
    chances = marginals(_scores(model, _bins(model.edges, lines)), layout(_chain_lengths(lines.row)), model.chain)
    words = np.bincount(lines.row, weights=lines.words, minlength=rows)
    good = np.bincount(lines.row, weights=lines.words * chances[:, 1], minlength=rows)
    return good / np.maximum(words, 1), words


def _logit(share: np.ndarray) -> np.ndarray:
    share = share.clip(1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def fit(texts: list[str], labels: list[int], rounds: int = ROUNDS) -> Model:
    """Learn from texts and their quality, 0 or 1."""
    truth = np.array(labels, dtype=np.int64)
    prior = float(truth.mean()) if len(truth) else 0.5
    joined = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in joined]))).astype(np.int64)
    lines = read_lines(np.frombuffer(b"".join(joined), dtype=np.uint8), offsets)
    width = lines.numbers.shape[1]
    levels = np.arange(1, BINS) / BINS
    edges = np.quantile(lines.numbers, levels, axis=0).T if len(lines.row) else np.zeros((width, BINS - 1))
    # Half of the edges between the least and the largest value: rare values matter where most lines have the same one.
    if len(lines.row):
        span = np.linspace(lines.numbers.min(axis=0), lines.numbers.max(axis=0), BINS + 1)[1:-1].T
        edges = np.sort(np.concatenate((edges, span), axis=1), axis=1)
    model = Model(edges, np.zeros((3, width, edges.shape[1] + 2, 2)), Chain(np.zeros((2, 2)), np.zeros(2)), 1.0, 0.0, prior)
    if not len(lines.row) or prior in (0.0, 1.0):
        model.slope, model.offset = 0.0, float(_logit(np.array([prior]))[0])
        return model
    label = truth[lines.row]
    bins, form, once = _bins(edges, lines), layout(_chain_lengths(lines.row)), np.eye(2)[label]
    inner = np.flatnonzero(lines.row[1:] == lines.row[:-1])
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (label[inner], label[inner + 1]), 1)
    first = np.flatnonzero(np.concatenate(([True], lines.row[1:] != lines.row[:-1])))
    seen_start = np.bincount(label[first], minlength=2)
    ascent = Ascent(0.2, 1e-2)
    for _ in range(rounds):
        chances, _, pairs, start = marginals(_scores(model, bins), form, model.chain, expected=True)
        error = once - chances
        gradient = np.zeros_like(model.weights)
        for side in range(3):
            for k in range(width):
                for y in range(2):
                    gradient[side, k, :, y] = np.bincount(bins[side, :, k], weights=error[:, y], minlength=gradient.shape[2])
        ascent.step("weights", model.weights, gradient)
        ascent.step("transitions", model.chain.transitions, seen_pairs - pairs)
        ascent.step("start", model.chain.start, seen_start - start)
    share, words = _good_share(model, lines, len(truth))
    x, y = _logit(share[words > 0]), truth[words > 0]
    curve, ascent = np.array([1.0, 0.0]), Ascent(0.1, 0.0)
    for _ in range(300):
        error = y - 1 / (1 + np.exp(-(curve[0] * x + curve[1])))
        ascent.step("curve", curve, np.array([(error * x).sum(), error.sum()]))
    model.slope, model.offset = max(float(curve[0]), 0.0), float(curve[1])
    return model


def score_rows(model: Model, octets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each text of a slice."""
    rows = len(offsets) - 1
    share, words = _good_share(model, read_lines(octets, offsets), rows)
    scores = 1 / (1 + np.exp(-(model.slope * _logit(share) + model.offset)))
    return np.where(words > 0, scores, model.prior)


def training_rows(
    docs: DataFrame, labels: DataFrame, text: str, id_column: str, label: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS
) -> list[tuple[str, int]]:
    """(text, label) of a bounded sample of the labelled rows; only its ids are looked up in the documents."""
    luck = F.xxhash64(F.lit("train"), id_column)
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isin(0, 1)).select(id_column, F.col(label).alias("_label"))
    chosen = known.orderBy(luck, id_column, "_label").limit(rows)
    # At most ``rows`` ids are broadcast.
    found = docs.where(F.length(text) <= chars).select(id_column, text).join(F.broadcast(chosen), id_column)
    drawn = found.orderBy(luck, id_column, "_label", text).limit(rows).select(text, "_label").collect()
    return [(r[0], r[1]) for r in drawn]


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS
) -> Model:
    """A model learned from a bounded sample of labelled documents, fitted on the driver."""
    sample = training_rows(docs, labels, text, id_column, label, rows)
    return fit([t for t, _ in sample], [y for _, y in sample])


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` of every whole text and ``predicted`` (1 from a score of one half)."""
    others = docs.drop(*[c for c in ("score", "predicted") if c != text])
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*others.schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = score_rows(shared.value, *text_bytes(batch.column(batch.schema.get_field_index(text))))
        columns = [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return others.mapInArrow(map_slices(work, text), schema)
