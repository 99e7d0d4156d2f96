"""Projection through CIGARs, votes and fragments against base-by-base Python."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.operators import alleles, coverage
from tagweave.operators import haplotag as hap
from tagweave.sinks import layouts

READS = "qname string, flag int, rname string, start long, end long, mapq int, cigar string, sequence string, quality string, bx string"
VARIANTS = "chrom string, pos long, ref string, alts array<string>, gt array<int>, phased boolean, ps long"


def walk(cigar, start):
    """Reference position -> read place of every aligned base."""
    at, place, aligned = start, 0, {}
    for n, kind in re.findall(r"(\d+)([MIDNSHP=X])", cigar or ""):
        for _ in range(int(n)):
            if kind in "M=X":
                aligned[at] = place
            at += kind in "MDN=X"
            place += kind in "MIS=X"
    return aligned, at


def shown(read, variant):
    """What the read shows of a variant and with which quality, or None."""
    aligned, _ = walk(read["cigar"], read["start"])
    pos, ref, options = variant["pos"], variant["ref"], [variant["ref"], *variant["alts"]]
    first, second = (options[g] for g in variant["gt"])
    begin = aligned.get(pos)
    single = len(ref) == len(first) == len(second) == 1
    end = None if begin is None else begin + 1 if single else aligned.get(pos + len(ref))
    if begin is None or end is None or read["sequence"] is None or end > len(read["sequence"]):
        return None
    marks = read["quality"] or ""
    quality = min(map(ord, marks[begin:end])) - 33 if len(marks) == len(read["sequence"]) else alleles.UNKNOWN_QUALITY
    bases = read["sequence"][begin:end].upper()
    return None if bases not in (first, second) else (int(bases == second and bases != first), quality)


def usable(read, min_mapq=0):
    return read["flag"] & alleles.SKIPPED_FLAGS == 0 and read["mapq"] >= min_mapq and read["rname"] is not None


def het(v):
    return len(v["alts"]) <= 2 and v["gt"][0] != v["gt"][1]


def units(reads, distance):
    out = {}
    groups = defaultdict(list)
    for k, r in enumerate(reads):
        if r["bx"] and r["rname"] is not None:
            groups[r["rname"], r["bx"]].append((r["start"], r["end"], k))
    for rows in groups.values():
        stop = None
        for start, end, k in sorted(rows):
            if stop is None or stop + distance < start:
                unit = start
            stop = end if stop is None else max(stop, end)
            out[k] = unit
    return out


def votes_of(reads, variants, distance, chosen, min_mapq=0, by_name=False):
    """(unit key, name, site) -> (side, quality) of joined mates."""
    unit = units(reads, distance) if distance is not None else {}
    held = defaultdict(list)
    for k, r in enumerate(reads):
        if not usable(r, min_mapq):
            continue
        for i, v in enumerate(variants):
            if v["chrom"] == r["rname"] and chosen(v) and r["start"] <= v["pos"] < r["end"] and (got := shown(r, v)):
                key = (r["rname"], r["bx"], unit[k]) if k in unit and not by_name else (r["rname"], r["qname"])
                held[key, r["qname"], i].append(got)
    return {key: (got[0][0], max(q for _, q in got)) for key, got in held.items() if len({s for s, _ in got}) == 1}


def plain_tags(reads, variants, distance):
    balance = defaultdict(lambda: defaultdict(int))
    for (key, _, i), (side, quality) in votes_of(reads, variants, distance, lambda v: het(v) and v["phased"] and v["ps"] is not None).items():
        balance[key][variants[i]["ps"]] += quality if side == 0 else -quality
    unit = units(reads, distance) if distance is not None else {}
    out = []
    for k, r in enumerate(reads):
        key = (r["rname"], r["bx"], unit[k]) if k in unit else (r["rname"], r["qname"])
        best = min(balance[key].items(), key=lambda t: (-abs(t[1]), t[0]), default=None) if r["flag"] & 4 == 0 and r["rname"] else None
        out.append((1 if best[1] > 0 else 2, best[0], abs(best[1])) if best and best[1] else (None, None, None))
    return out


def draw(seed, n=120, distance=60):
    choose = random.Random(seed)
    genome = "".join(choose.choice("ACGT") for _ in range(700))
    variants, pos = [], 5
    while pos < 640:
        ref = genome[pos : pos + choose.choice([1, 1, 1, 3])]
        alts = [choose.choice([b for b in "ACGT" if b != ref[0]])] if len(ref) == 1 and choose.random() < 0.7 else [ref[0] + choose.choice(["", "GG", "T"])]
        alts = [a if a != ref else ref + "A" for a in alts]
        gt = choose.choice([[0, 1], [1, 0], [1, 1]])
        ps = choose.choice([None, pos // 200, pos // 200])
        variants.append({"chrom": "c", "pos": pos, "ref": ref, "alts": alts, "gt": gt, "phased": choose.random() < 0.9, "ps": ps})
        pos += choose.randint(4, 25)
    by_pos = {v["pos"]: v for v in variants}
    reads = []
    for k in range(n):
        start, cigar, bases, at = choose.randint(0, 560), [], [], 0
        at = start
        if choose.random() < 0.3:
            cigar.append((4, "S"))
            bases.append("NNNN")
        for _ in range(choose.randint(1, 5)):
            size = choose.randint(1, 25)
            piece = list(genome[at : at + size])
            for p in range(at, at + size):
                v = by_pos.get(p)
                if v and len(v["ref"]) == 1 and len(v["alts"][0]) == 1 and choose.random() < 0.5:
                    piece[p - at] = v["alts"][0]
            cigar.append((size, choose.choice("M=X")))
            bases.append("".join(piece))
            at += size
            kind = choose.choice("IDN")
            size = choose.randint(1, 3)
            cigar.append((size, kind))
            if kind == "I":
                bases.append("".join(choose.choice("GT") for _ in range(size)))
            else:
                at += size
        cigar.append((1, "M"))
        bases.append(genome[at])
        text = "".join(bases).lower() if choose.random() < 0.1 else "".join(bases)
        quality = choose.choice(["*", None]) if choose.random() < 0.1 else "".join(chr(33 + choose.randint(0, 40)) for _ in text)
        reads.append(
            {"qname": f"q{k // 2}", "flag": choose.choice([0, 0, 0, 0, 16, 4, 1024, 256]), "rname": "c", "start": start, "end": at + 1, "mapq": choose.randint(0, 60),
             "cigar": "".join(f"{n}{c}" for n, c in cigar), "sequence": text, "quality": quality, "bx": choose.choice([None, "", "b1", "b1", "b2"])}
        )
    reads += [
        reads[0],
        reads[0] | {"cigar": None},
        reads[0] | {"cigar": "*", "sequence": "*"},
        reads[1] | {"rname": None, "start": None, "end": None, "flag": 4},
        reads[2] | {"sequence": None},
    ]
    return reads, variants


def frames(spark, reads, variants):
    columns = [c.split()[0] for c in READS.split(", ")]
    rows = spark.createDataFrame([tuple(r[c] for c in columns) for r in reads], READS).repartition(3)
    names = [c.split()[0] for c in VARIANTS.split(", ")]
    return rows, spark.createDataFrame([tuple(v[c] for c in names) for v in variants], VARIANTS)


def shown_rows(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("seed,distance", [(1, 60), (2, None), (3, 5)])
def test_haplotag(spark, seed, distance):
    reads, variants = draw(seed)
    rows, sites = frames(spark, reads, variants)
    got = hap.haplotag(rows, sites, distance, indels=True).select("qname", "start", "cigar", "bx", "hp", "ps", "pc").collect()
    tags = plain_tags(reads, variants, distance)
    assert shown_rows(got) == shown_rows((r["qname"], r["start"], r["cigar"], r["bx"], *t) for r, t in zip(reads, tags, strict=True))
    assert any(t[0] for t in tags)


def plain_fragments(reads, variants, distance, long=False):
    order = sorted(range(len(variants)), key=lambda i: (variants[i]["pos"], variants[i]["ref"], variants[i]["alts"]))
    index = {i: k for k, i in enumerate(order, 1)}
    wide = (lambda v: het(v) and len(v["ref"]) == 1 and all(len(a) == 1 for a in v["alts"])) if long else het
    balance = defaultdict(lambda: defaultdict(int))
    for (key, _, i), (side, quality) in votes_of(reads, variants, distance, wide, 20 if long else 0, by_name=long).items():
        if long or len(key) == 3:
            balance[key][i] += quality if side == 0 else -quality
    out = {}
    for key, sites in balance.items():
        called = sorted((index[i], (0 if b > 0 else 1) if variants[i]["gt"][0] < variants[i]["gt"][1] else (1 if b > 0 else 0), min(abs(b), 93)) for i, b in sites.items() if b)
        if len(called) < 2:
            continue
        blocks = []
        for k, (i, allele, quality) in enumerate(called):
            if not k or called[k - 1][0] + 1 < i:
                blocks.append([i, "", ""])
            blocks[-1][1] += str(allele)
            blocks[-1][2] += chr(33 + quality)
        out[key] = [tuple(b) for b in blocks]
    return out


def test_linked_fragments_and_their_text(spark):
    reads, variants = draw(4)
    rows, sites = frames(spark, reads, variants)
    found = hap.linked_fragments(rows, sites, 60, indels=True)
    got = {(r.rname, r.bx, r.unit): [tuple(b) for b in r.blocks] for r in found.collect()}
    expected = plain_fragments(reads, variants, 60)
    assert got == expected and any(len(b) > 1 for b in got.values())
    back = hap.parse_fragments(hap.linked_lines(found)).collect()
    assert {(r.name, r.barcode): [tuple(b) for b in r.blocks] for r in back} == {(f"{c}:{u}:{b}", b): v for (c, b, u), v in expected.items()}
    assert {r.variants for r in back} == {sum(len(b[1]) for b in v) for v in expected.values()}


def test_long_read_fragments(spark):
    reads, variants = draw(5)
    rows, sites = frames(spark, reads, variants)
    long = hap.long_read_fragments(rows, sites)
    got = {(r.rname, r.qname): [tuple(b) for b in r.blocks] for r in long.collect()}
    assert got == plain_fragments(reads, variants, None, long=True)
    merged = hap.merged_lines(hap.linked_lines(hap.linked_fragments(rows, sites, 60)), hap.long_lines(long))
    kinds = {r.kind for r in hap.parse_fragments(merged).select("kind").collect()}
    assert kinds == {hap.LINKED, hap.LONG}


def test_long_alignments_stay_linear():
    """Ten thousand operations in one read, and a site at every aligned base."""
    cigar = "3M1D2M1I" * 5000
    aligned, end = walk(cigar, 10)
    positions = np.arange(10, end)
    projection = alleles.Projection(["4M", cigar, None], np.array([0, 10, 0]))
    got = projection.places(np.full(len(positions), 1), positions)
    assert got.tolist() == [aligned.get(int(p), -1) for p in positions]
    assert projection.places(np.array([0, 0, 2]), np.array([3, 4, 0])).tolist() == [3, -1, -1]


def test_empty_tables(spark):
    reads, variants = draw(6, n=4)
    rows, sites = frames(spark, reads, variants)
    assert hap.haplotag(rows.limit(0), sites).count() == 0
    assert {r.hp for r in hap.haplotag(rows, sites.limit(0)).collect()} == {None}
    assert hap.linked_fragments(rows, sites.limit(0)).count() == 0


def test_alignments_back_to_reads(spark):
    rows = [
        ("a", 64, "AACG", "IJKL", "b1", "r1"),
        ("a", 128 | 16, "AACG", "IJKL", None, None),
        ("a", 128 | 256, "AACG", "IJKL", None, None),
        ("b", 64, "NAC", "*", "", None),
        ("c", 64 | 2048, "A", "I", None, None),
        ("d", 0, "*", None, None, None),
        ("e", 64, "A", "I", None, None),
        ("e", 64, "C", "I", None, None),
        ("e", 128, "G", "I", None, None),
    ]
    frame = spark.createDataFrame(rows, "qname string, flag int, sequence string, quality string, bx string, rx string")
    got = sorted((r.name, r.read, r.sequence, r.quality) for r in layouts.reads_of_alignments(frame).where("qname < 'e'").collect())
    assert got == [("a", 2, "CGTT", "LKJI"), ("a\tBX:Z:b1\tRX:Z:r1", 1, "AACG", "IJKL"), ("b\tBX:Z:", 1, "NAC", '"""'), ("d", 0, "", "")]
    assert [tuple(r) for r in layouts.pairs_of_alignments(frame).collect()] == [("a\tBX:Z:b1\tRX:Z:r1", "a", "AACG", "IJKL", "CGTT", "LKJI")]


def test_depth_of_names(spark):
    reads, _ = draw(8, n=60)
    rows, _ = frames(spark, reads, [])
    covered = defaultdict(set)
    for r in reads:
        if usable(r) and r["cigar"]:
            covered[r["qname"]] |= set(walk(r["cigar"], r["start"])[0])
    depth = defaultdict(int)
    for places in covered.values():
        for p in places:
            depth[p] += 1
    got = {p: r.depth for r in coverage.aligned_depth(rows, 64).collect() for p in range(r.start, r.end)}
    assert got == depth


def test_differences(spark):
    rows = [
        ("20M", "20", 20, 0, 0, 0, 0),
        ("5S10M2I8M", "3A0C4^", 18, 2, 2, 0, 1),
        ("10M3D5M1D5M", "2T7^ACG0A4^t5", 20, 2, 0, 4, 2),
        ("4=1X5N6M", "4g6", 11, 1, 0, 0, 0),
        ("*", None, 0, None, 0, 0, 0),
    ]
    frame = spark.createDataFrame([(0, 9, *r[:2]) for r in rows], "flag int, mapq int, cigar string, md string")
    got = [tuple(r) for r in frame.select(*[c.alias(n) for n, c in coverage.differences().items()]).collect()]
    assert got == [r[2:] for r in rows]
    total = coverage.difference_rates(frame).first()
    assert (total.records, total.aligned_bases, total.mismatches, total.gaps) == (5, 69, 5, 3)
    assert coverage.difference_rates(frame.limit(0)).first().mismatches_share is None


def test_fragments_of_many_blocks_are_parsed_in_one_pass(spark):
    n = 60000
    blocks = " ".join(f"{3 * i + 1} {'01' if i % 2 else '0'}" for i in range(n))
    marks = "".join("AB" if i % 2 else "C" for i in range(n))
    lines = spark.createDataFrame([(f"{n} m 2 b -1 {blocks} {marks}",), ("1 k 2 b -1 7 01 I",)], "line string")
    began = time.perf_counter()
    rows = {r.name: r for r in hap.parse_fragments(lines).collect()}
    assert time.perf_counter() - began < 30
    assert rows["m"].variants == len(marks)
    assert [b.qualities for b in rows["m"].blocks[:4]] == ["C", "AB", "C", "AB"] and rows["m"].blocks[-1].qualities == "AB"
    assert [b.qualities for b in rows["k"].blocks] == ["I"]


def test_reads_take_the_bins_of_their_length(spark):
    reads = spark.createDataFrame(
        [("a", "c", 10, 12, "2M", "AC", "II"), ("b", "c", 0, 3000, "1500M1500M", "AC" * 1500, "I" * 3000), ("d", "c", 60, 310, "250M", "AC" * 125, "I" * 250)],
        "qname string, rname string, start bigint, end bigint, cigar string, sequence string, quality string",
    )
    rows = [("c", p, 0, 1, "A", "C", 0) for p in range(0, 3000, 5)]
    sites = spark.createDataFrame(rows, "chrom string, pos bigint, ps bigint, span int, first string, second string, zero int")
    seen = {(r.qname, r.pos, r.side) for r in alleles.observed_alleles(reads, sites, ("qname", "rname")).collect()}
    spans = {"a": (10, 12), "b": (0, 3000), "d": (60, 310)}
    assert seen == {(q, p, (p - s) % 2) for q, (s, e) in spans.items() for p in range(0, 3000, 5) if s <= p < e}
    widths = alleles._spread(reads, F.col("start"), F.col("end") - 1, alleles.SITE_WIDTH).groupBy("qname").agg(F.max("_width").alias("w"), F.count(F.lit(1)).alias("n"))
    assert {r.qname: (r.w, r.n) for r in widths.collect()} == {"a": (64, 1), "b": (1024, 3), "d": (256, 2)}


def test_sites_keep_unknown_numbers_and_long_alleles_and_names_meet_once(spark):
    reads = spark.createDataFrame(
        [("a", "c", 10, 14, "4M", "ACGT", "IIII"), ("a", "c", 12, 16, "4M", "GGTT", "5555"), (None, "c", 2040, 2060, "20M", "ACGT" * 5, None)],
        "qname string, rname string, start bigint, end bigint, cigar string, sequence string, quality string",
    )
    rows = [("c", 11, None, 1, "C", "G", 1, 0), ("c", 12, 7, 1, "G", "A", 2, 1), ("c", 13, 7, 2, "TT", "T", 3, 0), ("c", 2050, None, 1, "A", "G", 4, 0)]
    sites = spark.createDataFrame(rows, "chrom string, pos bigint, ps bigint, span int, first string, second string, idx bigint, zero int")
    packed = alleles.packed_alleles(reads, sites, ("qname", "rname"))
    seen = {tuple(r) for r in alleles.unpacked(packed).select("qname", "pos", "ps", "idx", "zero", "side", "quality").collect()}
    assert seen == {("a", 11, None, 1, 0, 0, 40), ("a", 12, 7, 2, 1, 0, 40), ("a", 12, 7, 2, 1, 0, 20), (None, 2050, None, 4, 0, 1, 20)}
    votes = hap._packed_votes(packed, ["rname"])
    want = hap.joined_votes(alleles.unpacked(packed), ["rname"])
    assert sorted(map(str, votes.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # Sites are moved with their read, before they are unpacked: nothing is moved between unpacking and the votes.
    plan = votes._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate")] and "Exchange" in plan[plan.index("Generate") :]
