"""Fingerprints against a bit-by-bit model; groups against brute-force components."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tagweave.llm import golay, simhash

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values):
    """value -> smallest value reachable over steps of at most three bits."""
    values = sorted(set(values))
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for b in values[:i]:
                if bin(a ^ b).count("1") <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_code_is_perfect():
    values = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    index = golay.decode(values)
    assert index.max() < 1 << 12
    codewords = {}
    for message in range(1 << 12):
        codewords.setdefault(int(golay.decode(np.array([message << 11]))[0]), 0)
    assert len(codewords) > 1
    keys = [set(r) for r in golay.neighbour_indices(values).tolist()]
    assert {len(k) for k in keys} <= {1, 6}
    for bit in range(23):
        near = golay.decode(values ^ (1 << bit)).tolist()
        assert all(n in k for n, k in zip(near, keys, strict=True))


def test_keys_meet_within_three_bits():
    rng = random.Random(3)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        rows, keys, own = simhash.keys_of(np.array([a, b], dtype=np.uint64))
        assert set(keys[(rows == 0) & own]) & set(keys[rows == 1])
        assert ((rows == 0) & own).sum() == 8


@pytest.mark.parametrize("dense", [0, 5, 64])
def test_groups_of_planted_fingerprints(spark, dense):
    rng = random.Random(dense)
    values = [rng.getrandbits(64) for _ in range(60)]
    centre = rng.getrandbits(64)
    for _ in range(80):  # a dense cluster
        values.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for v in values[:30]:  # chains
        for _ in range(rng.randint(0, 3)):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            values.append(v)
    values += [0, 0, 7, (1 << 64) - 1]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    classes = prints.selectExpr("fingerprint as fp").distinct()
    label = components(values)
    found = simhash.links(classes, dense).collect()
    for a, b in ((r.a % (1 << 64), r.b % (1 << 64)) for r in found):
        assert label[a] == label[b]
    smallest = {}
    for i, v in enumerate(values):
        smallest[label[v]] = min(smallest.get(label[v], i), i)
    if dense == 64:
        got = {r.doc_id: r.component_id for r in simhash.group(prints).collect()}
        assert got == {i: smallest[label[v]] for i, v in enumerate(values)}
    else:
        edges = {v: v for v in set(values)}

        def root(x):
            while edges[x] != x:
                x = edges[x]
            return x

        for r in found:
            edges[root(r.a % (1 << 64))] = root(r.b % (1 << 64))
        for v in label:
            assert root(v) == root(label[v])


def test_texts(spark):
    base = " ".join(f"Word{i % 37} thing{i}" for i in range(300))
    texts = [None, "", " \n", "One", "ONE", "two words", base, base.upper(), base + " tail", base.replace("thing7 ", "other "), "x " * 30_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, base), (None, base), (None, "lonely text of its own")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [fingerprint(t) for _, t in rows]
    label = components(prints)
    ids = {}
    for (i, _), v in zip(rows, prints, strict=True):
        if i is not None:
            ids[label[v]] = min(ids.get(label[v], i), i)
    expected = sorted(((i, f"{v:016x}", ids.get(label[v])) for (i, _), v in zip(rows, prints, strict=True)), key=str)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected
    kept = simhash.representatives(docs.selectExpr("*", "'s' as source", "1 as root")).collect()
    assert sorted(label[fingerprint(r.text)] for r in kept) == sorted(set(label.values()))
    assert kept[0].__fields__ == ["doc_id", "text", "source", "root"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.representatives(docs).count() == 0


def test_a_null_id_is_no_text(spark):
    docs = spark.createDataFrame([(None, "a b c d")] * 3 + [("none", "a b c d")], "doc_id string, text string")
    assert [r.doc_id for r in simhash.representatives(docs).collect()] == ["none"]
