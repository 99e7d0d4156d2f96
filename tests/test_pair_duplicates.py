"""Duplicates by unclipped ends against plain loops."""

import random
import re
from collections import defaultdict

import pytest

from tagweave.operators.pair_duplicates import quality_sum
from tagweave.operators import pair_duplicates as pd_

SCHEMA = "qname string, flag int, rname string, start long, end long, cigar string, quality string, bx string"


def plain(reads, barcode):
    def end(r):
        lead = sum(map(int, re.findall(r"\d+", re.match(r"((?:\d+[SH])*)", r["cigar"] or "")[0])))
        trail = sum(map(int, re.findall(r"\d+", re.search(r"((?:\d+[SH])*)$", r["cigar"] or "")[0])))
        place = r["end"] - 1 + trail if r["flag"] & 16 else r["start"] - lead
        return r["rname"], place, bool(r["flag"] & 16), (r["bx"] or "") if barcode else ""

    def score(r):
        marks = r["quality"] or ""
        return 0 if marks == "*" else sum(ord(c) - 33 for c in marks if ord(c) - 33 >= 15)

    names = defaultdict(list)
    for k, r in enumerate(reads):
        if not r["flag"] & (4 | 256 | 2048) and r["rname"] and r["start"] is not None:
            names[r["qname"]].append(k)
    again, pairs, single = set(), defaultdict(list), defaultdict(list)
    for name, ks in names.items():
        if len(ks) == 2:
            pairs[tuple(sorted(end(reads[k]) for k in ks))].append((-sum(score(reads[k]) for k in ks), name, ks))
        else:
            for k in ks:
                single[end(reads[k])].append((-score(reads[k]), name, k))
    for group in pairs.values():
        for _, _, ks in sorted(group)[1:]:
            again.update(ks)
    ends = {e for key in pairs for e in key}
    for place, group in single.items():
        best = min(group)[1]
        again.update(k for _, name, k in group if place in ends or name != best)
    return [(r["flag"] & ~1024) | (1024 if k in again else 0) for k, r in enumerate(reads)]


def draw(seed, n=240):
    choose, reads = random.Random(seed), []
    for k in range(n):
        start = choose.choice([100, 103, 110, 500])
        cigar = choose.choice(["20M", "3S17M", "2H3S15M", "17M3S", "10M5D10M", "18M2S4H"])
        size = sum(int(x) for x, c in re.findall(r"(\d+)([A-Z])", cigar) if c in "MDN=X")
        lead = sum(int(x) for x in re.findall(r"\d+", re.match(r"((?:\d+[SH])*)", cigar)[0]))
        quality = choose.choice([None, "*"]) if choose.random() < 0.1 else "".join(chr(33 + choose.randint(0, 40)) for _ in range(6))
        flag = choose.choice([0, 16, 0, 16, 1024, 4, 256, 2048])
        rname = None if flag & 4 and choose.random() < 0.5 else choose.choice("cd")
        reads.append(
            {"qname": f"q{k // 2 if k < 180 else k}", "flag": flag, "rname": rname, "start": start + lead, "end": start + lead + size, "cigar": cigar, "quality": quality,
             "bx": choose.choice([None, "b1", "b1"])}
        )
    reads += [dict(reads[0], qname="three", flag=0, rname="c")] * 3
    return reads


@pytest.mark.parametrize("seed,barcode", [(1, "bx"), (2, None)])
def test_marks(spark, seed, barcode):
    reads = draw(seed)
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = spark.createDataFrame([tuple(r[c] for c in columns) for r in reads], SCHEMA).repartition(3)
    marked = pd_.mark_pair_duplicates(frame, barcode)
    flags = plain(reads, barcode)
    expected = sorted((tuple({**r, "flag": f}[c] for c in columns) for r, f in zip(reads, flags, strict=True)), key=str)
    assert sorted((tuple(r) for r in marked.collect()), key=str) == expected
    assert 0 < sum(f & 1024 > 0 for f in flags) < len(flags)
    row = pd_.duplication_metrics(marked).first()
    assert row.fragments + 2 * row.pairs + row.others == len(reads)
    assert row.fragment_duplicates + 2 * row.pair_duplicates == sum(f & 1024 > 0 for f in flags)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert pd_.mark_pair_duplicates(frame).count() == 0
    assert pd_.duplication_metrics(frame).first().duplication == 0.0


def test_quality_sums_are_taken_a_batch_at_a_time(spark):
    texts = ["", "*", None, "!" * 9, "0" * 3, chr(33 + 14) * 5 + chr(33 + 15), "I" * 100000, "~5/A"]
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(texts)], "i int, quality string")
    summed = rows.select("i", quality_sum().alias("score"))
    plain = {i: sum(ord(c) - 33 for c in q or "" if ord(c) - 33 >= 15) if q != "*" else 0 for i, q in enumerate(texts)}
    assert {r.i: r.score for r in summed.collect()} == plain
    assert summed.where("i < 0").count() == 0
    # No step for every character of every read.
    assert "lambdafunction" not in summed._jdf.queryExecution().optimizedPlan().toString()


def test_names_over_batches_and_one_move_by_name(spark):
    """Names of one, two and many records, three rows a batch: pairs by both ends, others a record each."""
    choose = random.Random(7)
    rows = [(f"n{k:02d}", f"e{choose.randint(0, 9)}", choose.randint(0, 50)) for k in range(30) for _ in range(choose.choice([1, 2, 2, 3, 11]))]
    frame = spark.createDataFrame([*rows, (None, "e1", 5)], "qname string, _end string, score long").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        units = pd_._units(frame)
        got = sorted((tuple(r) for r in units.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = defaultdict(list)
    for name, end, score in rows:
        held[name].append((end, score))
    want = []
    for name, group in held.items():
        if len(group) == 2:
            want.append((name, min(group)[0], max(group)[0], sum(s for _, s in group)))
        else:
            want += [(name, end, None, score) for end, score in group]
    assert got == sorted(want, key=str)
    plan = units._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("RepartitionByExpression [qname") == 1


def test_ends_are_told_apart(spark):
    """Chromosomes and barcodes whose texts join to the same string are different ends."""
    rows = [("a", 0, "c1", 5, 9, "4M", None, "2x"), ("b", 0, "c12", 5, 9, "4M", None, "x"), ("d", 16, "c1", 2, 6, "4M", None, "2x"), ("e", 0, "c1", 5, 9, "4M", "IIII", "2x")]
    marked = {r.qname: r.flag & 1024 for r in pd_.mark_pair_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert marked == {"a": 1024, "b": 0, "d": 0, "e": 0}
