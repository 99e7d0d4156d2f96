"""Language of texts by a linear-chain conditional random field over words.

Each word is scored for every language by its affixes, its letter n-grams, its own identity and its place in the lexicons (frequent words of one
language in the training texts); learned transitions say how likely the language changes from word to word. Forward-backward gives
each word's language probabilities, also in text that switches languages. Chains run along lines. A text's language is the one with
the largest mean probability over its words, which is its score.

The field is fitted on at most ``TRAIN_ROWS`` texts (the same number of each language, or all it has), the first by a hash of id and text within
their language, each of at most ``TRAIN_CHARS`` characters. Pieces of lines of different texts are strung together for that, so that transitions between languages are seen. Every language
has at least one text in the sample (of more languages than ``TRAIN_ROWS``, the most frequent ones). Prediction reads whole texts.

Defined cases: a null text, and one without any letter, is ``und`` with score 1; no training rows: every text is ``und`` with score 0; repeated rows are
predicted alike; extra columns of the input stay, and result columns win over input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.crf import Ascent, Chain, layout, marginals
from tagweave.llm.octets import SLICE_BYTES, SpanHashes, byte_table, map_slices, mixed, spans, text_bytes

TRAIN_ROWS = 800
TRAIN_CHARS = 20_000
ROUNDS = 40
# A word belongs to a language's lexicon if it is seen this often, nine times in ten in that language.
LEXICON_COUNT = 5
UNKNOWN = "und"
_FEATURE_BITS = 17
_AFFIXES = (1, 2, 3, 4)
_LETTERS = byte_table((0x61, 0x7A), (0x80, 0xFF))
_NOT_NEWLINE = ~byte_table((0x0A, 0x0A))


@dataclass
class Model:
    """Learned scores; words in a lexicon by hash. A feature's slot says which row of weights is its own; row 0 is of those not seen."""

    languages: list[str]
    slots: np.ndarray
    weights: np.ndarray
    lexicon_words: np.ndarray
    lexicon_language: np.ndarray
    lexicon_weights: np.ndarray
    chain: Chain


@dataclass
class Words:
    """Words of texts (lower-cased): chains of them, and the distinct ones with their features."""

    row: np.ndarray
    chain_lengths: np.ndarray
    kind: np.ndarray
    kind_hash: np.ndarray
    features: np.ndarray
    feature_bounds: np.ndarray


def _slots(hashes: np.ndarray, template: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(template * 0x51ED270B)) >> np.uint64(64 - _FEATURE_BITS)).astype(np.int64)


def read_words(octets: np.ndarray, offsets: np.ndarray) -> Words:
    """Words, chains and features of a slice of lower-cased texts."""
    starts, ends, bounds = spans(octets, offsets, _LETTERS)
    line_starts, _, _ = spans(octets, offsets, _NOT_NEWLINE)
    line = np.searchsorted(line_starts, starts, side="right")
    lengths = np.bincount(line)
    hashes = SpanHashes(octets)
    kind_hash, first, kind = np.unique(hashes.of(starts, ends), return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    owner, slots = [np.arange(len(s))], [_slots(kind_hash, 0)]
    for k in _AFFIXES:
        owner += [owner[0], owner[0]]
        slots += [_slots(hashes.of(s, np.minimum(s + k, e)), 2 * k), _slots(hashes.of(np.maximum(e - k, s), e), 2 * k + 1)]
    for n in (2, 3):
        count = np.maximum(e - s - n + 1, 0)
        of = np.repeat(owner[0], count)
        at = s[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        owner.append(of)
        slots.append(_slots(hashes.of(at, at + n), 20 + n))
    owners, features = np.concatenate(owner), np.concatenate(slots)
    order = np.argsort(owners, kind="stable")
    feature_bounds = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(s)))))
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return Words(row, lengths[lengths > 0], kind, kind_hash, features[order], feature_bounds)


def _lexicon_of(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words that are in a lexicon, and whose."""
    if not len(model.lexicon_words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(model.lexicon_words, words.kind_hash), len(model.lexicon_words) - 1)
    known = np.flatnonzero(model.lexicon_words[at] == words.kind_hash)
    return known, model.lexicon_language[at[known]]


def _kind_scores(model: Model, words: Words) -> np.ndarray:
    """Scores of each distinct word: the mean over its features, and what its lexicon says."""
    if not len(words.kind_hash):
        return np.zeros((0, len(model.languages)))
    sums = np.add.reduceat(model.weights[model.slots[words.features]], words.feature_bounds[:-1], axis=0)
    scores = sums / np.sqrt(np.diff(words.feature_bounds))[:, None]
    known, language = _lexicon_of(model, words)
    scores[known] += model.lexicon_weights[language]
    return scores


def fit(texts: list[str], languages: list[str], seed: int = 11, rounds: int = ROUNDS) -> Model | None:
    """Learn from lower-cased texts and their languages."""
    names = sorted(set(languages))
    if not names:
        return None
    label_of_text = np.searchsorted(names, languages)
    joined = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in joined])))
    words = read_words(np.frombuffer(b"".join(joined), dtype=np.uint8), offsets)
    labels, count = label_of_text[words.row], len(names)

    # Chains for training: pieces of up to 40 words of lines of random texts, three to a chain.
    rng = np.random.default_rng(seed)
    begins = np.concatenate(([0], np.cumsum(words.chain_lengths)))
    cuts = np.concatenate([np.arange(b, e, 40) for b, e in zip(begins[:-1], begins[1:], strict=True)]) if len(begins) > 1 else begins[:0]
    ends = np.append(cuts[1:], begins[-1])
    shuffled = rng.permutation(len(cuts))
    tokens = np.concatenate([np.arange(cuts[k], ends[k]) for k in shuffled]) if len(cuts) else cuts
    sizes = (ends - cuts)[shuffled]
    sizes = np.add.reduceat(sizes, np.arange(0, len(sizes), 3)) if len(sizes) else sizes
    kind, label = words.kind[tokens], labels[tokens]
    form, truth = layout(sizes), np.eye(count)[label]

    seen = np.zeros((len(words.kind_hash), count))
    np.add.at(seen, (kind, label), 1)
    total = seen.sum(axis=1)
    frequent = np.flatnonzero((total >= LEXICON_COUNT) & (seen.max(axis=1, initial=0) >= 0.9 * total))
    slots, met = np.zeros(1 << _FEATURE_BITS, dtype=np.int32), np.unique(words.features)
    slots[met] = np.arange(1, len(met) + 1)
    model = Model(
        names,
        slots,
        np.zeros((len(met) + 1, count)),
        words.kind_hash[frequent],
        seen[frequent].argmax(axis=1),
        np.zeros((count, count)),
        Chain(np.zeros((count, count)), np.zeros(count)),
    )
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(sizes) else np.zeros(0, dtype=np.int64)
    follows = np.ones(len(kind), dtype=bool)
    follows[first] = False
    seen_pairs = np.zeros((count, count))
    inner = np.flatnonzero(follows)
    np.add.at(seen_pairs, (label[inner - 1], label[inner]), 1)
    seen_start = np.bincount(label[first], minlength=count)
    known, known_language = _lexicon_of(model, words)
    spread = np.repeat(np.arange(len(words.kind_hash)), np.diff(words.feature_bounds))
    scale = 1 / np.sqrt(np.diff(words.feature_bounds))
    ascent = Ascent(0.3, 1e-3)
    for _ in range(rounds if len(kind) else 0):
        scores = _kind_scores(model, words)[kind]
        chances, _, pairs, start = marginals(scores, form, model.chain, expected=True)
        error = truth - chances
        by_kind = np.column_stack([np.bincount(kind, weights=error[:, k], minlength=len(scale)) for k in range(count)])
        scaled = by_kind * scale[:, None]
        gradient = np.column_stack(
            [np.bincount(slots[words.features], weights=scaled[spread, k], minlength=len(met) + 1) for k in range(count)]
        )
        lexicon = np.zeros((count, count))
        np.add.at(lexicon, known_language, by_kind[known])
        ascent.step("weights", model.weights, gradient)
        ascent.step("lexicon", model.lexicon_weights, lexicon)
        ascent.step("transitions", model.chain.transitions, seen_pairs - pairs)
        ascent.step("start", model.chain.start, seen_start - start)
    model.weights = model.weights.astype(np.float32)
    return model


def word_chances(model: Model, octets: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of lower-cased texts and the language probabilities of each."""
    words = read_words(octets, offsets)
    scores = _kind_scores(model, words).astype(np.float64)[words.kind]
    return words, marginals(scores, layout(words.chain_lengths), model.chain)


def predict_rows(model: Model | None, octets: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each lower-cased text; unknown where it has no word."""
    rows = len(offsets) - 1
    if model is None:
        return [UNKNOWN] * rows, np.zeros(rows)
    words, chances = word_chances(model, octets, offsets)
    count = np.bincount(words.row, minlength=rows)
    means = np.column_stack(
        [np.bincount(words.row, weights=chances[:, k], minlength=rows) for k in range(len(model.languages))]
    ) / np.maximum(count, 1)[:, None]
    best = means.argmax(axis=1)
    names = [model.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), count.tolist(), strict=True)]
    return names, np.where(count > 0, means[np.arange(rows), best].clip(0, 1), 1.0)


def has_letter(text: str | Column) -> Column:
    """Whether a text has a letter of any script; false for a null."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).rlike("\\p{L}"), F.lit(False))


def training_rows(
    docs: DataFrame, text: str, lang: str, id_column: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS
) -> list[tuple[str, str]]:
    """(lower-cased text, language) of a bounded sample, the same number of each language or all it has."""
    usable = docs.where(F.col(lang).isNotNull() & has_letter(text) & (F.length(text) <= chars))
    counts = usable.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), lang).limit(rows).collect()
    if not counts:
        return []
    each = max(rows // len(counts), 1)
    luck = F.pmod(F.xxhash64(F.lit("train"), id_column, text), F.lit(1 << 30))
    # Rows that may be among the first of their language: so many more than needed that too few are hardly ever drawn.
    enough = each + 6 * each**0.5 + 12
    shares = F.create_map(*[F.lit(v) for r in counts for v in (r[0], int((1 << 30) * min(1.0, enough / r["n"])))])
    wanted = luck < F.try_element_at(shares, F.col(lang))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_luck", "_id"))
    drawn = (
        usable.where(wanted)
        .select(F.lower(text).alias("_text"), F.col(lang).alias("_lang"), luck.alias("_luck"), F.col(id_column).alias("_id"))
        .withColumn("_place", place)
        .where(F.col("_place") <= each)
        .orderBy("_luck", "_id")
        .select("_text", "_lang")
        .collect()
    )
    return [(r[0], r[1]) for r in drawn]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id", rows: int = TRAIN_ROWS) -> Model | None:
    """A model learned from a bounded sample of ``docs``, fitted on the driver."""
    sample = training_rows(docs, text, lang, id_column, rows)
    return fit([t for t, _ in sample], [name for _, name in sample])


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of every whole text."""
    others = docs.drop(*[c for c in ("lang_pred", "score") if c != text])
    lowered = others.withColumn("_lower", F.when(has_letter(text), F.lower(text)))
    schema = T.StructType([*others.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        octets, offsets = text_bytes(batch.column(batch.num_columns - 1))
        names, scores = predict_rows(shared.value, octets, offsets)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names), pa.array(scores)], names=schema.names)

    # A word takes room for every language.
    limit = SLICE_BYTES if model is None else SLICE_BYTES * 8 // max(len(model.languages), 8)
    return lowered.mapInArrow(map_slices(work, "_lower", limit), schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept out of all learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
