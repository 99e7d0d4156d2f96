"""Secrets in texts, by DataFrame functions only: fixed patterns, and windowed entropy over candidate strings.

Fixed patterns find assignments (``token = ...``), access keys and long hexadecimal strings. Beyond them, candidate strings (runs of letters,
digits and ``+/_=-`` that hold a digit and a letter) are judged by the Shannon entropy of a window of ``WINDOW`` characters that slides over them. Counts
of characters, and the sum of c*log2(c) over them, are kept up as one character enters and one leaves, so a step does not recount the
window. Every character class has its threshold: hexadecimal, lower-case or upper-case letters with digits, both cases, base64. The span
reaches from the first window above its threshold to the last.

Candidates are looked for in what fixed patterns leave of the text. Runs of letters and digits with a placeholder's word (``EXAMPLEKEY``) are no part of
a candidate. What is left of it is judged as a whole if it has separators, and each of its runs of letters and digits on its own; identifiers in a fixed
layout, numbers, and paths and slugs of plain words are allowed.

Places are code points; a match's place is the total length of the pieces and matches before it. Running places of many matches are summed block
by block, so the work grows with the text, however many matches it has.

Defined cases: a null text is an empty one and has no spans; an empty table gives none; repeated rows are scanned one by one; spans of one place are listed
in the order of their kinds; very long texts are scanned whole; extra columns of the input stay, and result columns win over input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The shortest assigned value that counts.
ASSIGNED = 8
# Matches that are too short are dropped; for these two kinds a shorter one never hides a longer one.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# Items of an array that are walked at once.
BLOCK = 256
HEX_BITS = 3.0
MIXED_BITS = 4.0
CANDIDATE = "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{%d,}" % WINDOW
ALLOWED = (
    "(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",  # UUIDs
    "^[0-9+/_=-]+$",  # numbers, dates
    "^([A-Za-z]{0,15}|[0-9]{1,8})([/_=+-]+([A-Za-z]{0,15}|[0-9]{1,8}))+$",  # paths and slugs of words and numbers
)
# By class: what 99 of 100 strings of WINDOW random characters reach (32, 36, 62 and 64 characters to choose from).
CLASS_BITS = {"upper": 3.34, "lower": 3.4, "mixed": 3.64, "base64": 3.64}
# Words of placeholders: the run of letters and digits around one is no part of a candidate.
PLACEHOLDER = "(?i)example|sample|placeholder|changeme|xxxx|0123456789|abcdef"
RUN = "[A-Za-z0-9]{%d,}" % WINDOW
# What is left of a candidate as a whole; only those with a separator are judged as such.
WHOLE = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
SEPARATOR = "[+/_=-]"
MASK = "[SECRET]"


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas inside use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _carried(items: Column, emit: Callable[[Column, Column], Column], advance: Callable[[Column, Column], Column], kind: str) -> Column:
    """``emit(at, item)`` of every item, where ``at`` starts at 0 and becomes ``advance(at, item)``; ``kind`` is the type of what is emitted.

    Places are carried from block to block first, so that arrays grow inside blocks of ``BLOCK`` items only.
    """
    nothing = F.array().cast(f"array<{kind}>")

    def step(state: Column, item: Column) -> Column:
        return F.struct(advance(state["at"], item).alias("at"), F.array_append(state["out"], emit(state["at"], item)).alias("out"))

    def of_blocks(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks, F.array(F.lit(0)), lambda at, block: F.array_append(at, F.aggregate(block, F.element_at(at, -1), advance))
        )

        def of_block(at: Column) -> Callable[[Column, Column], Column]:
            return lambda block, i: F.aggregate(
                block, F.struct(F.element_at(at, i + 1).alias("at"), nothing.alias("out")), step, lambda state: state["out"]
            )

        return _with(begins, lambda at: F.flatten(F.transform(blocks, of_block(at))))

    def cut(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), (F.size(all_) / BLOCK).cast("int"))
        return _with(F.transform(numbers, lambda i: F.slice(all_, i * BLOCK + 1, BLOCK)), of_blocks)

    return _with(items, cut)


def _found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, match); the text is searched again only if there is one."""
    kind = "struct<start:int,end:int,match:string>"
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")
    )

    def emit(at: Column, part: Column) -> Column:
        start = at + F.length(part["gap"])
        return F.struct(start.alias("start"), (start + F.length(part["match"])).alias("end"), part["match"].alias("match"))

    def advance(at: Column, part: Column) -> Column:
        return at + F.length(part["gap"]) + F.coalesce(F.length(part["match"]), F.lit(0))

    # The last gap has no match.
    found = F.filter(_carried(parts, emit, advance, kind), lambda m: m["match"].isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{kind}>"))


def _between(text: Column, spans: Column, fill: Callable[[Column, Column], Column]) -> Column:
    """The text with each of its sorted spans replaced by ``fill(at, span)``, where ``at`` is the end of all spans before it."""
    kind = "struct<at:int,start:int,end:int>"

    def emit(at: Column, s: Column) -> Column:
        return F.struct(at.alias("at"), s["start"].alias("start"), s["end"].alias("end"))

    def of_pieces(pieces: Column) -> Column:
        def part(begin: Column, end: Column) -> Column:
            first = (begin / BLOCK).cast("int")
            held = F.slice(pieces, first + 1, (F.greatest(end - 1, F.lit(0)) / BLOCK).cast("int") - first + 1)
            return F.when(end > begin, F.substring(F.array_join(held, ""), begin - first * BLOCK + 1, end - begin)).otherwise("")

        last = F.struct(F.length(text).alias("start"), F.length(text).alias("end"))
        ends = F.concat(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), F.array(last))
        cuts = _carried(ends, emit, lambda at, s: F.greatest(at, s["end"]), kind)
        return F.array_join(F.transform(cuts, lambda c: F.concat(part(c["at"], c["start"]), fill(c["at"], c))), "")

    return _with(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0)), of_pieces)


def _bits(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def entropy_range(candidate: Column, threshold: Column, window: int = WINDOW) -> Column:
    """(first, last): starts of the first and the last window whose entropy reaches ``threshold``; null if none does.

    Counts of the window's characters are kept as a string: the letter at a character's code says how often it occurs.
    """
    begin = F.struct(
        F.lit("A" * 128).alias("counts"),
        F.lit(0.0).cast("double").alias("total"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def of_codes(codes: Column) -> Column:
        def held(counts: Column, code: Column) -> Column:
            return F.ascii(F.substring(counts, code + 1, F.lit(1))) - ord("A")

        def counted(counts: Column, code: Column, n: Column) -> Column:
            return F.overlay(counts, F.char(n + ord("A")), code + 1, F.lit(1))

        def entered(state: Column, place: Column) -> Column:
            code = F.element_at(codes, place)
            n = held(state["counts"], code)
            return F.struct(
                counted(state["counts"], code, n + 1).alias("counts"), (state["total"] + _bits(n + 1) - _bits(n)).alias("total")
            )

        def left(state: Column, place: Column) -> Column:
            code = F.element_at(codes, F.greatest(place - window, F.lit(1)))
            n = held(state["counts"], code)
            gone = F.struct(
                counted(state["counts"], code, n - 1).alias("counts"), (state["total"] - _bits(n) + _bits(n - 1)).alias("total")
            )
            return F.when(place > window, gone).otherwise(state)

        def step(state: Column, place: Column) -> Column:
            def rated(now: Column) -> Column:
                high = (place >= window) & (F.log2(F.lit(float(window))) - now["total"] / window >= threshold)
                start = F.when(high, place - window)
                return F.struct(
                    now["counts"].alias("counts"),
                    now["total"].alias("total"),
                    F.coalesce(state["first"], start).alias("first"),
                    F.coalesce(start, state["last"]).alias("last"),
                )

            return _with(_with(entered(state, place), lambda now: left(now, place)), rated)

        return F.aggregate(
            F.sequence(F.lit(1), F.size(codes)), begin, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
        )

    return _with(F.transform(F.regexp_extract_all(candidate, F.lit("."), F.lit(0)), lambda c: F.ascii(c)), of_codes)


def _threshold(shown: Column) -> Column:
    """Bits a character that windows of a string of this class have to reach."""
    upper, lower = shown.rlike("[A-Z]"), shown.rlike("[a-z]")
    return (
        F.when(shown.rlike("^[0-9a-fA-F]+$"), HEX_BITS)
        .when(shown.rlike(SEPARATOR), F.when(upper & lower, CLASS_BITS["base64"]).otherwise(MIXED_BITS))
        .when(~upper, CLASS_BITS["lower"])
        .when(~lower, CLASS_BITS["upper"])
        .otherwise(CLASS_BITS["mixed"])
    )


def _entropy_spans(rest: Column) -> Column:
    """Spans with a window of high entropy in a text whose fixed patterns are blanked; each once."""

    def without_placeholders(shown: Column) -> Column:
        runs = F.regexp_extract_all(shown, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
        blank = F.transform(runs, lambda r: F.when(r.rlike(PLACEHOLDER), F.repeat(F.lit(" "), F.length(r))).otherwise(r))
        return F.when(shown.rlike(PLACEHOLDER), F.array_join(blank, "")).otherwise(shown)

    def pieces(c: Column) -> Column:
        def of(left: Column) -> Column:
            found = F.concat(_found(left, RUN), F.filter(_found(left, WHOLE), lambda m: m["match"].rlike(SEPARATOR)))
            return F.transform(found, lambda m: F.struct((m["start"] + c["start"]).alias("start"), m["match"].alias("match")))

        return _with(without_placeholders(c["match"]), of)

    def wanted(p: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | p["match"].rlike(pattern)
        return p["match"].rlike("[A-Za-z]") & p["match"].rlike("[0-9]") & ~allowed

    def judged(p: Column) -> Column:
        return _with(
            entropy_range(p["match"], _threshold(p["match"])),
            lambda high: _span(3, p["start"] + high["first"], p["start"] + high["last"] + WINDOW),
        )

    candidates = F.flatten(F.transform(_found(rest, CANDIDATE), pieces))
    found = F.filter(F.transform(F.filter(candidates, wanted), judged), lambda s: s["start"].isNotNull())
    return _with(F.array_sort(found), lambda all_: F.filter(all_, lambda s, i: (i == 0) | (s != F.get(all_, i - 1))))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``secrets``: sorted arrays of (start, kind, end); kinds are numbered as in :data:`KINDS`."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def assigned(m: Column) -> Column:
        return F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGNED

    spans = [
        F.transform(F.filter(_found(whole, ASSIGN), assigned), lambda m: _span(0, m["start"], m["end"])),
        F.transform(_found(whole, ACCESS), lambda m: _span(1, m["start"], m["end"])),
        F.transform(_found(whole, HEX), lambda m: _span(2, m["start"], m["end"])),
    ]
    based = docs.drop(*[c for c in ("base", "secrets") if c != text]).withColumn("base", F.array_sort(F.concat(*spans)))

    def blank(at: Column, s: Column) -> Column:
        return F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(at, s["start"]), F.lit(0)))

    rest = F.when(F.size("base") > 0, _between(whole, F.col("base"), blank)).otherwise(whole)
    more = F.when(whole.rlike(CANDIDATE), _with(rest, _entropy_spans)).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>")
    )
    return based.withColumn("secrets", F.array_sort(F.concat("base", more)))


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


def masked(docs: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mask``; spans that overlap are replaced as one."""

    def fill(at: Column, s: Column) -> Column:
        # The last cut is the empty one at the text's end.
        return F.when((s["start"] >= at) & (s["end"] > s["start"]), F.lit(mask)).otherwise("")

    clean = F.when(F.size("secrets") > 0, _between(F.col(text), F.col("secrets"), fill)).otherwise(F.col(text))
    return scan(docs, text).withColumn("_clean", clean).withColumn(text, F.col("_clean")).select(*docs.columns)
