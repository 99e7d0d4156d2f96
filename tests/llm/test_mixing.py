"""Targets, quotas and draws of the mix."""

import re
from collections import defaultdict

import numpy as np
import pytest

from tagweave.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, source string, text string"


def model_targets(sizes, repeats=3):
    """Share by weight; cut at the limit, share the excess again by weight among the others, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    stopped = {}
    while True:
        free = [s for s in names if s not in stopped]
        rest = sum(sizes.values()) - sum(stopped.values())
        share = {s: weight[s] * rest / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return share | stopped
        stopped |= {s: repeats * sizes[s] for s in above}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 3},
        {"a": 1, "b": 1, "c": 1, "d": 5000, None: 0},
        {"b": 7, None: 100, "aé": 30, "Z": 0, "z": 2, "zz": 90, "𐐷": 14},
        {"only": 12},
        {"x": 0},
        {f"s{i}": (i * i * 37) % 101 for i in range(40)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(model_targets(sizes))


def corpus():
    rng = np.random.default_rng(5)
    sources = ["a"] * 120 + ["b"] * 40 + ["c"] * 200 + [None] * 30 + ["tiny"] * 2
    rows = [(i, s, " ".join(f"w{j}" for j in range(int(rng.integers(1, 90))))) for i, s in enumerate(sources)]
    rows += [(1000, "a", "long " * 5000), (1001, "a", None), (1002, "b", ""), (None, "c", "no id here"), (7, *rows[7][1:]), (1003, "empty", " \n")]
    rows += [(1001, "a", None)]
    return rows


def test_mix_takes_what_it_should(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as size", "'x' as shard")
    pieces = mixing.mix(docs, block_words=32, blocks_per_shard=10)
    drawn = [r for r in pieces.collect() if r.shard is not None]
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target = model_targets(sizes)
    taken, blocks = defaultdict(int), defaultdict(set)
    for r in drawn:
        assert 0 <= r.word_begin < r.word_end <= r.size and 0 <= r.copy < 3
        taken[r.key] += r.word_end - r.word_begin
        blocks[r.shard].add(r.position)
    for source, want in target.items():
        assert abs(taken["-" if source is None else f"={source}"] - want) <= 0.5
    # Shards hold nearly equal numbers of blocks, numbered from 0 within each.
    counts = [len(v) for v in blocks.values()]
    assert max(counts) - min(counts) <= 1 and all(v == set(range(len(v))) for v in blocks.values())
    assert sorted(blocks) == list(range(len(blocks))) and len(blocks) > 20
    # No word is taken twice in one run through the stream.
    spans = defaultdict(list)
    for r in drawn:
        spans[r.key, r.start, r.doc_id, r.told, r.copy].append((r.word_begin, r.word_end))
    for own in spans.values():
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))

    result = mixing.taken_words(pieces).collect()
    assert len(result) == len(rows)
    assert sorted((r.doc_id or -1, r.size) for r in result) == sorted((i or -1, len(WORD.findall(t or ""))) for i, _, t in rows)
    assert all(r.taken <= 3 * r.size for r in result)
    again = mixing.taken_words(mixing.mix(docs.repartition(7), block_words=32, blocks_per_shard=10)).collect()
    assert sorted(map(str, result)) == sorted(map(str, again))


def test_mixed_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mixed_documents(docs, block_words=64, blocks_per_shard=8).collect()
    assert all(r.taken == sum(p.word_end - p.word_begin for p in r.pieces) > 0 for r in got)
    assert len({(r.doc_id, r.source, r.text) for r in got}) == len(got)
    assert got[0].__fields__[:3] == ["doc_id", "source", "text"]


def test_tree_in_two_levels(spark, monkeypatch):
    quotas = {"a": 700, "b": 41, "c": 0, "d": 259}
    table = spark.createDataFrame(list(quotas.items()), "source string, blocks long").where("blocks > 0")
    flat = sorted(map(tuple, mixing.shard_ranges(table, 64, 1000).collect()))
    monkeypatch.setattr(mixing, "_UPPER", 8)
    assert sorted(map(tuple, mixing.shard_ranges(table, 64, 1000).collect())) == flat
    per_shard, per_source = defaultdict(int), defaultdict(list)
    for source, shard, begin, count in flat:
        per_shard[shard] += count
        per_source[source].append((begin, begin + count))
    assert set(per_shard.values()) == {15, 16}
    for source, ranges in per_source.items():
        ranges.sort()
        assert ranges[0][0] == 0 and ranges[-1][1] == quotas[source]
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_hypergeometric_law():
    rng = np.random.default_rng(2)
    for good, total, draws in [(5, 20, 8), (300, 1000, 500), (1, 2, 1), (0, 9, 4), (9, 9, 4)]:
        ours = [mixing.hypergeometric(u, good, total, draws) for u in rng.random(4000)]
        mean = draws * good / total
        spread = (mean * (1 - good / total) * (total - draws) / max(total - 1, 1)) ** 0.5
        assert abs(np.mean(ours) - mean) <= 4 * spread / 60 + 1e-9
        assert abs(np.std(ours) - spread) <= 0.1 * spread + 1e-9
    assert abs(mixing.hypergeometric(0.5, 10**10, 3 * 10**10, 10**10) - 10**10 / 3) < 10**5


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.taken_words(mixing.mix(docs)).count() == 0
    assert mixing.mixed_documents(docs).count() == 0


def test_a_null_id_is_no_text(spark):
    docs = spark.createDataFrame([(None, "a", "one two three four five"), ("none", "a", "one two three four five")], "doc_id string, source string, text string")
    got = mixing.mixed_documents(docs).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == [("None", 5), ("none", 5)]
