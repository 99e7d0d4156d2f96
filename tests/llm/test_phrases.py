"""Phrase collocations against plain Python; the sort against sorted()."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import phrases

SCHEMA = "lang string, text string"


def plain(rows, max_words=3, least=10, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, tuple(words[k : k + size])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                inner = (lang, words[k : k + size])
                longer[inner] = max(longer[inner], a)
    out = []
    for lang in {k[0] for k in candidates}:
        scored = []
        for (own, words), a in candidates.items():
            if own != lang or 100 * longer[own, words] >= 50 * a:
                continue
            cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def sentences(n, seed=0, vocabulary=12):
    choose = random.Random(seed)
    words = [f"W{k}" for k in range(vocabulary)] + ["über", "Été", "日本", "x'y"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(choose.randint(1, 60)):
            parts.append(choose.choice(words if choose.random() < 0.6 else words[:3]) + choose.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!?"]))
        rows.append((choose.choice(["en", "de", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize("options", [{}, {"route_bytes": 700}, {"route_bytes": 60}, {"max_words": 2}, {"max_words": 4, "route_bytes": 900}, {"top": 5}])
def test_against_plain(spark, options):
    rows = sentences(150)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    known = {k: v for k, v in options.items() if k != "route_bytes"}
    assert got(phrases.collocations(frame, **options)) == plain(rows, **known)


def test_hot_pair_is_spread(spark):
    """A pair in every text, with many continuations, is counted exactly whichever way its suffixes are routed."""
    rows = [("en", f"of the w{k % 37} of the w{k % 11}; a b") for k in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for route_bytes in (10**9, 2000, 200):
        assert got(phrases.collocations(frame, route_bytes=route_bytes)) == plain(rows)


def test_held_rows_are_joined(spark, monkeypatch):
    rows = sentences(80, seed=3)
    monkeypatch.setattr(phrases, "HELD_ROWS", 50)
    blocks = phrases.frequencies(spark.createDataFrame(rows, SCHEMA).repartition(4), route_bytes=3000)
    assert blocks.where("n_words = 0").agg(F.sum("f")).first()[0] == sum(
        len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t)) for _, t in rows
    )


def test_defined_cases(spark):
    rows = [("en", None), ("en", ""), (None, " .,;\n"), ("fr", "a b " * 40_000), ("fr", "A B"), ("fr", "A B")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"phrase": F.lit("x"), "rank": F.lit(1), "f": F.lit(2)})
    assert got(phrases.collocations(frame)) == plain(rows)
    assert got(phrases.collocations(frame.limit(0))) == []


def test_large_counts_are_exact(spark):
    big = 10**14 + 7
    frame = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    exact = phrases._exact
    squared = exact(F.col("a")) * exact(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)")
    row = frame.withColumn("x", squared).withColumn("y", exact(F.col("l")) * exact(F.col("r"))).select(F.expr("x div y")).first()
    assert row[0] == 10**6 * big * big // ((big + 1) * (big + 3))


@pytest.mark.parametrize("least", [1, 4])
def test_sort(least):
    choose = np.random.Generator(np.random.Philox(5))
    for n in (0, 1, 2, 300):
        symbols = choose.integers(0, 4, size=(4, n)).astype(np.int32)
        for d in range(1, 4):
            symbols[d] = np.where(symbols[d - 1] == 0, 0, symbols[d])
        done = phrases.multikey_sort(symbols, least=least, known=2)
        rows = [tuple(symbols[:, k].tolist()) for k in done.order]
        assert sorted(done.order.tolist()) == list(range(n))
        kept = [row for row, left in zip(rows, done.left, strict=True) if not left]
        assert kept == sorted(kept) and [r[:2] for r in rows] == sorted(r[:2] for r in rows)
        weight = Counter(r[:2] for r in rows)
        assert [bool(x) for x in done.left] == [weight[r[:2]] < least for r in rows]
        for k in range(1, n):
            if not done.left[k]:
                shared = next((d for d in range(4) if rows[k][d] != rows[k - 1][d]), 4)
                assert done.common[k] == shared
