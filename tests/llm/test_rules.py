"""Counts of the quality rules against plain Python over the same texts."""

import re
from collections import Counter

from pyspark.sql import types as T

from tagweave.llm import rules

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.StringType())])

TEXTS = [
    None,
    "",
    " \n\t\n ",
    "one",
    "a b c a b c",
    "x y x y x y\nx y x y x y\n\n\n last | # line",
    "é ü ß   word\r\nword\r\n" * 3,
    "Home | About | Contact | News\n" + "plain words of a clean line, really.\n" * 2,
    "\n".join(f"Sentence number {i} has words {i * 7} unlike all other lines {i * i}." for i in range(40)),
    "\n".join(f"w{i} | v{i} | u{i} | t{i}" for i in range(40)),
    "\n".join(" ".join(f"w{i}{j}###" for j in range(10)) for i in range(10)),
    "word" * 50_000,
    " ".join(f"w{i % 1000}" for i in range(60_000)),
    *["\n".join(" ".join(f"w{k}{i}{j}{mark}" for j in range(14)) for i in range(5)) for k, mark in enumerate(["!!", "%%", " »", " ›", " /", "!", "#", ""])],
    "\n".join(" ".join(str(i * j + 1000) for j in range(14)) for i in range(9)),
]


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


def verdict(text):
    text = text or ""
    words, _, _, _, repeat = expected(text)
    if words < 50 or 100 * repeat > 50 * words:
        return False
    lost, seen = 0, set()
    for line in text.split("\n"):
        n = len(WORD.findall(line))
        if n and (line in seen or rules.line_fails(line.encode())):
            lost += n
        seen.add(line)
    return lost <= 0.5 * words


def left_over(text):
    seen, out = set(), []
    for line in text.split("\n"):
        worded = WORD.search(line) is not None
        if not (worded and (line in seen or rules.line_fails(line.encode()))):
            out.append(line)
        if worded:
            seen.add(line)
    return "\n".join(out)


def test_clean(spark):
    lines = [f"Sentence number {i} has words {i * 7} unlike all other lines {i * i}." for i in range(12)]
    dirty = "\n".join([*lines[:6], "Home | About | Contact | News", "", lines[2], *lines[6:], "accept cookies", "é" * 2_000_000, ""])
    texts = [*TEXTS, dirty, "\n".join(lines) + "\n\n"]
    rows = [(i, t, "mine") for i, t in enumerate(texts)] + [(None, dirty, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    made = rules.clean(docs)
    assert made.columns == docs.columns
    got = sorted(((r.doc_id or -1, r.text, r.kept) for r in made.collect()), key=str)
    assert got == sorted(((i or -1, left_over(t), k) for i, t, k in rows if verdict(t)), key=str)
    kept = {i: t for i, t, _ in got}
    assert "Home" not in kept[len(TEXTS)] and "cookies" not in kept[-1] and kept[len(TEXTS) + 1] == texts[-1]
    assert rules.clean(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_and_verdict(spark):
    rows = [(i, t, "mine") for i, t in enumerate(TEXTS)] + [(3, "one", None), (None, TEXTS[8], "x")]
    got = rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert got[0].__fields__[:2] == ["doc_id", "text"] and got[0].__fields__.count("kept") == 1
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected(r.text), r.text
        assert r.kept == verdict(r.text)
    kept = {r.doc_id: r.kept for r in got if r.doc_id is not None}
    assert kept[8] and not kept[9] and not kept[10]


def test_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_line_rules():
    assert rules.line_fails(b"Home | About | Contact | News")
    assert rules.line_fails(b"--- --- ---")
    assert rules.line_fails("We use cookies: accept cookies".encode())
    assert not rules.line_fails(b"A plain sentence, with nothing wrong about it.")
    assert not rules.line_fails(b"a | b or so the grammar of pipes says in prose that goes on")
    assert rules.cleaned("good line here\nHome | About | Contact | News\ngood line here\n\nend of it") == "good line here\n\nend of it"
