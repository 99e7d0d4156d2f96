"""Repeated strings against a count of every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tagweave.llm import repeats


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), hashlib.sha256(kept).hexdigest()))
    return out


def sample(seed):
    rng = random.Random(seed)
    letters = "abé𐐷 \n"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [make(n) for n in (10, 19, 20, 21, 40, 90)]
    texts = [None, "", "a", "a" * 100, "ab" * 40, make(50), make(18)]
    for _ in range(40):
        parts = [make(rng.randint(0, 30)), rng.choice(shared), make(rng.randint(0, 30)), rng.choice(shared)]
        texts.append("".join(parts))
    base = make(150)
    for _ in range(25):  # near copies: one letter changed
        k = rng.randrange(len(base))
        texts.append(base[:k] + rng.choice(letters) + base[k + 1 :])
    return [*texts, texts[-1], base, base, texts[9]]


@pytest.mark.parametrize(("limit", "collection"), [(4096, 2048), (4096, 5), (2, 2048)])
def test_against_every_string(spark, limit, collection):
    texts = sample(limit + collection)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as removed", "1 as told")
    got = repeats.remove_repeats(docs, length=24, piece=6, limit=limit, collection=collection).orderBy("doc_id").collect()
    want = expected(texts, 24)
    assert len(got) == len(want)
    for r, (size, gone, spans, digest) in zip(got, want, strict=True):
        assert (r.n_bytes, r.n_removed, [tuple(s) for s in r.removed], r.kept_sha256) == (size, gone, spans, digest), r.text


def test_production_length(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "délta", "epsilon", "zeta"]
    make = lambda n: " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(n))
    passage = make(80)
    texts = [make(300) + passage + make(20), passage, make(5) + passage[:-1] + make(700), make(60), make(60), "x" * 401, "y" * 400, make(9000)]
    texts += [texts[3], passage[:399], texts[4] + "!", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.remove_repeats(docs).orderBy("doc_id").collect()
    for r, (size, gone, spans, digest) in zip(got, expected(texts, 400), strict=True):
        assert (r.n_bytes, r.n_removed, [tuple(s) for s in r.removed], r.kept_sha256) == (size, gone, spans, digest)


def test_anchors_do_not_follow_the_size_of_a_slice(spark):
    # The first and the last eight bytes have hashes that agree in their upper 44 bits, and the larger one stands first.
    rng, passage = random.Random(3), "qoizzipsayspxdvc"
    filler = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    texts = [passage, f"{passage} {filler}"]
    # The second text has a slice of its own.
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = repeats.remove_repeats(docs, length=16, piece=8).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r.removed] for r in got] == [[(0, 16)], [(0, 16)]]


def test_column_order_finds_neighbours():
    strings = [b"xxabcd", b"yyabcd", b"zzabce", b"qqabcd"]
    again = repeats.sort_columns(strings, np.array([2, 2, 2, 2]), np.array([0, 0, 0, 1]), 4)
    assert again[:, 2].tolist() == [True, True, False, False] and not again[:, :2].any()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0
