"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns (electronic mail, internet addresses, payment cards, telephone numbers) give the base spans. Around digits and ``@`` the
text is cut into atoms (numbers, words, single marks, blanks); the field scores whole candidate spans of at most ``MAX_ATOMS`` atoms by features of the span
as a whole (its digits and groups, separators, check digit, what stands before it) and dynamic programming over bounded spans
chooses boundaries and kinds together. Atoms outside any span score zero. Its spans are added where they touch no base span: numbers without
their ``+``, addresses with the ``@`` spelled out, and the like.

The field is fitted on at most ``TRAIN_ROWS`` texts of at most ``TRAIN_CHARS`` characters that have a digit or ``@``, labelled by the
patterns (of all their stretches and matches at most ``TRAIN_STRETCHES`` and ``TRAIN_MATCHES`` by lot), on copies of them with the tell-tale marks taken away, and on made-up entities and harmless numbers, so it is defined on any corpus.

Places are code points, ends exclusive. Defined cases: a null text is an empty one and has no spans; very long texts are scanned whole; repeated rows are
scanned one by one; extra columns of the input stay, and result columns win over input columns of the same name.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.crf import Ascent
from tagweave.llm.octets import map_slices

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 300
TRAIN_CHARS = 20_000
TRAIN_STRETCHES = 2_400
TRAIN_MATCHES = 1_200
MAX_ATOMS = 16
MAX_SPAN = 64
# Text within this many characters of a digit or mark is cut into atoms.
REACH = 48
ROUNDS = 30

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number that does not stand before three more never matches from a later digit of its own either.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_MARKS = re.compile(r"[0-9@]+|[(\[]at[)\]]", re.IGNORECASE)
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|[^\S\n]+|[\s\S]")
_SPELLED = re.compile(r"[(\[]\s*at\s*[)\]]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the check-digit rule of payment cards."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            out.append((0, begin, match.end()))
            done = match.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for match in _IP.finditer(text):
        if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in match.group().split(".")):
            out.append((1, match.start(), match.end()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, match.start(), match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in match.group()) <= 15:
                out.append((3, match.start(), match.end()))
    return out


def islands(text: str) -> list[list[tuple[int, int]]]:
    """Atoms, as (start, end), of the stretches of text near a digit or mark; no stretch crosses a line end."""
    out: list[list[int]] = []
    for match in _MARKS.finditer(text):
        near = max(match.start() - REACH, 0)
        begin = max(near, text.rfind("\n", near, match.start()) + 1)
        stop = text.find("\n", match.end(), match.end() + REACH)
        end = min(match.end() + REACH, len(text)) if stop < 0 else stop
        if out and begin <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([begin, end])
    return [[m.span() for m in _ATOM.finditer(text, b, e)] for b, e in out]


_CONTEXT = (
    ("mail", "contact", "write"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "pay"),
    ("phone", "tel", "call", "mobile", "fax"),
)
_DIGIT_STEPS = (0, 6, 8, 9, 12, 15, 16, 19)
WIDTH = len(_DIGIT_STEPS) + 1 + 6 + 18 + len(_CONTEXT)


def span_features(text: str, start: int, end: int) -> np.ndarray:
    """Features of a candidate span as a whole."""
    span = text[start:end]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    lengths = [len(g) for g in groups]
    at, spelled = span.count("@"), len(_SPELLED.findall(span))
    letters = any(c.isalpha() for c in span)
    before, after = text[start - 1 : start], text[end : end + 1]
    words = text[max(start - 24, 0) : start].lower()
    out = np.zeros(WIDTH)
    out[sum(len(digits) > step for step in _DIGIT_STEPS)] = 1
    k = len(_DIGIT_STEPS) + 1
    out[k + min(len(groups), 5)] = 1
    k += 6
    quads = len(groups) == 4 and span == ".".join(groups)
    marks = set(span) - set("0123456789")
    flags = (
        True,
        at == 1,
        spelled == 1,
        at + spelled > 1,
        (at + spelled == 1) and bool(re.search(r"[.]|dot", span.rpartition("@")[2] if at else _SPELLED.split(span)[-1], re.IGNORECASE)),
        quads and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        quads,
        13 <= len(digits) <= 19 and luhn(digits),
        13 <= len(digits) <= 19 and not luhn(digits),
        not letters and len(groups) >= 3 and max(lengths) <= 4 and 9 <= len(digits) <= 15,
        "(" in span and ")" in span and not letters,
        letters and not (at or spelled),
        span[:1] == "+",
        bool(marks - set(" -().+")) and not letters,
        len(groups) >= 3 and lengths[0] == 4 and lengths[1] <= 2 and lengths[2] <= 2,
        before.isalnum() or before in ("@", "_", "$", "#", "/"),
        after.isalnum() or after in ("@", "_", "%", "/"),
        bool(re.match(r"[.,:-][0-9]", text[end : end + 2])) or bool(re.search(r"[0-9][.,:-]$", text[max(start - 2, 0) : start])),
    )
    out[k : k + 18] = flags
    out[k + 18 :] = [any(w in words for w in group) for group in _CONTEXT]
    return out


def candidates(text: str, atoms: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(first atom, last atom) of the spans that may be an entity, and their features."""
    kinds = ["d" if text[s].isdecimal() else "w" if text[s].isalpha() else text[s] for s, _ in atoms]
    places, rows = [], []
    for i, kind in enumerate(kinds):
        if kind not in "dw+(":
            continue
        digits = marked = False
        for j in range(i, min(i + MAX_ATOMS, len(atoms))):
            start, end = atoms[i][0], atoms[j][1]
            if end - start > MAX_SPAN or kinds[j] in ",;" or (kinds[j] in " \t" and end - atoms[j][0] > 1):
                break
            digits = digits or kinds[j] == "d"
            marked = marked or kinds[j] == "@" or (kinds[j] in "([" and bool(_SPELLED.match(text, atoms[j][0])))
            if kinds[j] in "dw" and (marked or (digits and kind != "w" and kinds[j] == "d")):
                places.append((i, j))
                rows.append(span_features(text, start, end))
    if not places:
        return np.zeros((0, 2), dtype=np.int64), np.zeros((0, WIDTH))
    return np.array(places), np.array(rows)


def _by_last(places: np.ndarray, atoms: int) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(atoms)]
    for k, last in enumerate(places[:, 1].tolist()):
        out[last].append(k)
    return out


def best_spans(places: np.ndarray, scores: np.ndarray, atoms: int) -> list[tuple[int, int]]:
    """(candidate, kind) of the best cut of an island into entities and single atoms."""
    kind, top = scores.argmax(axis=1), scores.max(axis=1)
    best, via = [0.0] * (atoms + 1), [-1] * (atoms + 1)
    for j, own in enumerate(_by_last(places, atoms)):
        best[j + 1] = best[j]
        for k in own:
            total = best[places[k, 0]] + top[k]
            if total > best[j + 1]:
                best[j + 1], via[j + 1] = total, k
    out, j = [], atoms
    while j:
        if via[j] < 0:
            j -= 1
        else:
            out.append((via[j], int(kind[via[j]])))
            j = int(places[via[j], 0])
    return out[::-1]


def span_chances(places: np.ndarray, scores: np.ndarray, atoms: int) -> np.ndarray:
    """Probability of every (candidate, kind) by forward-backward over all cuts."""
    whole = np.logaddexp.reduce(scores, axis=1)
    ending, starting = _by_last(places, atoms), _by_last(places[:, ::-1], atoms)
    forward, backward = np.zeros(atoms + 1), np.zeros(atoms + 1)
    for j, own in enumerate(ending):
        ways = [forward[j], *[forward[places[k, 0]] + whole[k] for k in own]]
        forward[j + 1] = np.logaddexp.reduce(ways)
    for i in range(atoms - 1, -1, -1):
        ways = [backward[i + 1], *[backward[places[k, 1] + 1] + whole[k] for k in starting[i]]]
        backward[i] = np.logaddexp.reduce(ways)
    around = forward[places[:, 0]] + backward[places[:, 1] + 1] - forward[atoms]
    return np.exp(scores + around[:, None])


@dataclass
class Example:
    """An island with its candidates and the entities that are in it."""

    atoms: int
    places: np.ndarray
    features: np.ndarray
    truth: np.ndarray


def _example(text: str, atoms: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> Example | None:
    places, features = candidates(text, atoms)
    if not len(places):
        return None
    truth = np.zeros((len(places), len(KINDS)))
    known = {(s, e): k for k, s, e in spans}
    for row, (i, j) in enumerate(places.tolist()):
        kind = known.get((atoms[i][0], atoms[j][1]))
        if kind is not None:
            truth[row, kind] = 1
    return Example(len(atoms), places, features, truth)


def _made_up(rng: random.Random) -> list[tuple[str, str, int | None]]:
    """(text before, span, kind or None) of invented entities and of harmless numbers."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 8)))

    def card(ok: bool) -> str:
        while True:
            digits = rng.choice("3456") + number(15)
            if luhn(digits) == ok:
                cut = rng.choice(["", " ", "-"])
                return cut.join(digits[i : i + 4] for i in range(0, 16, 4))

    phones = ["(%s) %s-%s", "%s-%s-%s", "+1 (%s) %s-%s", "+1 %s %s %s", "%s.%s.%s", "+1-%s-%s-%s"]
    out: list[tuple[str, str, int | None]] = []
    for _ in range(25):
        name, host = f"{word()}{rng.choice(['', '.', '_'])}{word()}".replace("_", "."), word()
        out += [
            (word(), f"{name}{number(2)}@{host}.{rng.choice(['com', 'org', 'de'])}", 0),
            (word(), f"{word()} {rng.choice(['(at)', '[at]'])} {host} {rng.choice(['(dot)', '[dot]'])} com", 0),
            (word(), f"{word()}{rng.choice(['(at)', '[at]'])}{host}.com", 0),
            (word(), ".".join(str(rng.randint(0, 255)) for _ in range(4)), 1),
            (word(), card(True), 2),
            (word(), rng.choice(phones) % (number(3), number(3), number(4)), 3),
            (rng.choice(["phone", "call", "tel"]), rng.choice(phones) % (number(3), number(3), number(4)), 3),
        ]
        harmless = [
            card(False),
            number(rng.randint(1, 12)),
            number(rng.randint(13, 19)) + "1",
            f"20{number(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
            f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{number(2)}",
            f"{rng.randint(1, 12)}:{number(2)}",
            f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}",
            f"{rng.randint(256, 999)}.{number(3)}.{number(3)}.{number(3)}",
            f"{number(3)},{number(3)}",
            f"{number(2)} {number(2)} {number(2)}",
            f"{number(3)}-{number(3)}",
            f"{number(2)}-{number(3)}-{number(2)}",
            f"{number(4)} {number(4)}",
            f"@{word()}",
        ]
        out += [(word(), text, None) for text in harmless]
    return out


def _stripped(text: str, span: tuple[int, int, int]) -> tuple[str, tuple[int, int, int]]:
    """The text with the mark that gives an entity away taken off, and the entity's new place."""
    kind, start, end = span
    if kind == 3:
        return text[:start] + text[start + 1 :], (kind, start, end - 1)
    if kind == 0:
        spelled = text[start:end].replace("@", " (at) ")
        return text[:start] + spelled + text[end:], (kind, start, start + len(spelled))
    return text, span


@cache
def _invented() -> tuple[Example, ...]:
    rng, out = random.Random(17), []
    for before, span, kind in _made_up(rng):
        text = f"and {before} {span} then"
        start = len(before) + 5
        spans = [] if kind is None else [(kind, start, start + len(span))]
        out += [_example(text, atoms, spans) for atoms in islands(text)]
    return tuple(e for e in out if e)


def learned_from(
    texts: list[str], stretches: int = TRAIN_STRETCHES, matches: int = TRAIN_MATCHES
) -> tuple[list[tuple[str, list[tuple[int, int]]]], list[tuple[str, tuple[int, int, int]]]]:
    """Stretches (text, atoms) and pattern matches (text, span) to learn from: all of the texts, or as many as the bounds allow, by lot."""
    rng = random.Random(23)
    near = [(text, atoms) for text in texts for atoms in islands(text)]
    found = [(text, span) for text in texts for span in base_spans(text)]
    return rng.sample(near, min(len(near), stretches)), rng.sample(found, min(len(found), matches))


def fit(texts: list[str], rounds: int = ROUNDS) -> np.ndarray:
    """Weights (kind, feature) learned from texts labelled by the patterns, and from invented ones."""
    examples: list[Example | None] = list(_invented())
    stretches, matches = learned_from(texts)
    labels = {text: base_spans(text) for text, _ in stretches}
    examples += [_example(text, atoms, labels[text]) for text, atoms in stretches]
    for text, span in matches:
        near = text[max(span[1] - 60, 0) : span[2] + 60]
        moved = (span[0], min(span[1], 60), min(span[1], 60) + span[2] - span[1])
        changed, place = _stripped(near, moved)
        # Other entities nearby would lack their labels.
        if len(base_spans(near)) == 1:
            examples += [_example(changed, atoms, [place]) for atoms in islands(changed)]
    used = [e for e in examples if e]
    weights = np.zeros((len(KINDS), WIDTH))
    ascent = Ascent(0.5, 1e-2)
    observed = sum((e.truth.T @ e.features for e in used), np.zeros_like(weights))
    for _ in range(rounds):
        expected = np.zeros_like(weights)
        for e in used:
            expected += span_chances(e.places, e.features @ weights.T, e.atoms).T @ e.features
        ascent.step("weights", weights, observed - expected)
    return weights


def added_spans(text: str, weights: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that the field finds apart from the base ones."""
    if not _MARKS.search(text):
        return []
    out = []
    taken = sorted((s, e) for _, s, e in base)
    for atoms in islands(text):
        places, features = candidates(text, atoms)
        if not len(places):
            continue
        for k, kind in best_spans(places, features @ weights.T, len(atoms)):
            start, end = atoms[places[k, 0]][0], atoms[places[k, 1]][1]
            if not any(s < end and start < e for s, e in taken):
                out.append((kind, start, end))
    return out


def training_texts(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[str]:
    """A bounded sample of the texts that have a digit or ``@``, by the hash of the text.

    They are counted first, so that about as many as are wanted reach the driver, and not so many from each task.
    """
    usable = docs.where(F.col(text).rlike("[0-9@]") & (F.length(text) <= chars)).select(text)
    luck, known = F.pmod(F.xxhash64(F.lit("train"), text), F.lit(1 << 30)), usable.count()
    share = min(1.0, 1.25 * rows / max(known, 1))
    return [r[0] for r in usable.where(luck < int((1 << 30) * share)).orderBy(luck, text).limit(rows).collect()]


def train(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from a bounded sample of ``docs``, fitted on the driver."""
    return fit(training_texts(docs, text, rows))


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def find(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``found`` (base and added): arrays of (kind, start, end), by kind, then start."""
    others = docs.drop(*[c for c in ("base", "found") if c != text])
    schema = T.StructType([*others.schema.fields, T.StructField("base", _SPANS), T.StructField("found", _SPANS)])
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, found = [], []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            own = base_spans(value) if value else []
            both = sorted(own + added_spans(value, shared.value, own)) if value else []
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
            found.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in both])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, type=kind), pa.array(found, type=kind)], names=schema.names)

    return others.mapInArrow(map_slices(work, text), schema)


def listed(spans: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(kind: str, spans: str = "base") -> Column:
    """How many spans of a kind there are."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
