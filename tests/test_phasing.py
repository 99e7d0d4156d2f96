"""Haplotype errors: the published example and random phasings against a sequential walk."""

import random

import pytest

from tagweave.operators import phasing, variants

SCHEMA = "chrom string, ps bigint, idx bigint, pos bigint, g0 int, g1 int, alleles array<string>"
EXAMPLE = [
    [(1, 10, "01", "01"), (2, 20, "01", "01")],
    [(4, 30, "01", "10"), (5, 40, "01", "10"), (7, 50, "01", "01"), (8, 60, "01", "01")],
    [(10, 70, "01", "01"), (11, 80, "01", "10"), (13, 110, "01", "01")],
    [(15, 120, "01", "10"), (16, 130, "01", "10"), (18, 150, "01", "01"), (19, 160, "01", "01"), (20, 190, "01", "10")],
]


def test_published_example(spark):
    ref, asm = [], []
    for block in EXAMPLE:
        for idx, pos, first, second in block:
            ref.append(("c", block[0][1], idx, pos, int(first[0]), int(first[1]), ["A", "C"]))
            asm.append(("c", block[0][1], idx, pos, int(second[0]), int(second[1]), ["A", "C"]))
    ref, asm = spark.createDataFrame(ref, SCHEMA), spark.createDataFrame(asm, SCHEMA)
    report = {r.chrom: r for r in phasing.haplotype_report(asm, ref).collect()}["All"]
    assert (report.switch_count, report.switch_positions) == (2, 3)
    assert (report.mismatch_count, report.mismatch_positions) == (2, 14)
    assert (report.flat_count, report.flat_positions) == (5, 14)
    assert report.n50 == 40 and report.an50 == pytest.approx(30.0)
    assert report.ng50 is None and report.auqng is None


def errors_of(pairs):
    """Switch and mismatch places of one block pair: (wrong0, wrong1, usable, ordinal) in order."""
    usable = [i for i, p in enumerate(pairs) if p[2]]
    outcome = []
    for allele in (0, 1):
        wrong = [p[allele] for p in pairs]
        lead, at = 0, usable[0]
        while at + 1 < len(pairs) and pairs[at + 1][3] == pairs[at][3] + 1 and wrong[at + 1] != wrong[at]:
            lead, at = lead + 1, at + 1
        pending, state = lead % 2 == 1, wrong[usable[0]]
        switches, mismatches = [], []
        for place, i in enumerate(usable[1:], start=1):
            if wrong[i] == state:
                pending = False
                continue
            state = wrong[i]
            if pending:
                mismatches.append(place)
                switches = switches[:-1]
            else:
                switches.append(place)
            pending = not pending
        if pending:
            mismatches.append(len(usable) - 1)
            switches = switches[:-1]
        outcome.append((switches, mismatches))
    return outcome[0] if len(outcome[0][0]) < len(outcome[1][0]) else outcome[1]


def split_of(positions, indices, switches, mismatches):
    spans, start = [], 0
    for place, kind in sorted([(p, "s") for p in switches] + [(p, "m") for p in mismatches]):
        here = place - start
        stop = place - 1 if kind == "m" else place
        if here > (2 if kind == "m" else 1):
            spans.append((start, stop))
        start = place
    if len(positions) - start > 1:
        spans.append((start, len(positions)))
    return sorted((positions[b - 1] - positions[a], b - a, indices[b - 1] - indices[a] + 1) for a, b in spans)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_phasings(spark, monkeypatch, seed):
    monkeypatch.setattr(phasing, "WIDTH", 8)
    rng = random.Random(seed)
    asm, ref = [], []
    for idx in range(1, 500):
        pos, block, truth_block = idx * 10, idx // 60, idx // 90
        if rng.random() < 0.9:
            a = rng.random() < 0.5
            asm.append(("c", block, idx, pos, int(a), int(not a), ["A", "C"]))
            if rng.random() < 0.85:
                b = a if rng.random() < 0.7 else not a
                other = 2 if rng.random() < 0.1 else 1
                alleles = ["A", "G"] if rng.random() < 0.05 else ["A", "C"]
                ref.append(("c", truth_block, idx, pos, other * int(b), other * int(not b), alleles))
    pairs, segments = phasing.compare_phasings(spark.createDataFrame(asm, SCHEMA), spark.createDataFrame(ref, SCHEMA))
    got_pairs = {(r.ref_ps, r.ps): (r.switches, r.mismatches) for r in pairs.collect()}
    got_segments = {}
    for r in segments.collect():
        got_segments.setdefault((r.ref_ps, r.ps), []).append((r.span, r.variants, round(r.span * r.variants / r.adjusted_span)))
    truth = {r[3]: r for r in ref}
    groups, ordinals = {}, {}
    for _, ps, idx, pos, g0, g1, alleles in asm:
        ordinals[ps] = ordinals.get(ps, 0) + 1
        if pos in truth:
            _, ref_ps, _, _, t0, t1, t_alleles = truth[pos]
            usable = {g0, g1} == {t0, t1} and alleles == t_alleles
            groups.setdefault((ref_ps, ps), []).append((t0 != g0, t0 != g1, usable, ordinals[ps], pos, idx))
    for key, rows in groups.items():
        if not any(r[2] for r in rows):
            continue
        switches, mismatches = errors_of(rows)
        assert got_pairs[key] == (len(switches), len(mismatches)), key
        kept = [r for r in rows if r[2]]
        assert sorted(got_segments.get(key, [])) == split_of([r[4] for r in kept], [r[5] for r in kept], switches, mismatches)


def test_unset_phase_sets(spark):
    def row(chrom, pos, ps):
        return (chrom, pos, "A", ["C"], [0, 1], True, ps, 50.0, ["PASS"])

    schema = "chrom string, pos bigint, ref string, alts array<string>, gt array<int>, phased boolean, ps bigint, qual double, filter array<string>"
    df = spark.createDataFrame([row("a", 1, None), row("a", 2, None), row("b", 1, None), row("b", 2, None), row("b", 3, 3), row("b", 4, 3), row("b", 5, 5)], schema)
    kept = {(r.chrom, r.ps, r.pos) for r in variants.block_rows(df).collect()}
    assert kept == {("a", -1, 1), ("a", -1, 2), ("b", 3, 3), ("b", 3, 4)}


def test_soft_filter_spellings():
    expected = [("QUAL < 15", "lowQUAL"), ("MQRankSum > 6.0", "highMQRankSum"), ("AF < 0.15", "snpLowAF")]
    for text in ("'QUAL < 15','lowQUAL';'MQRankSum > 6.0','highMQRankSum';'AF < 0.15','snpLowAF'",
                 "QUAL < 15,lowQUAL;MQRankSum > 6.0,highMQRankSum;AF < 0.15,snpLowAF",
                 " QUAL < 15,lowQUAL; MQRankSum > 6.0,highMQRankSum; AF < 0.15,snpLowAF"):
        assert variants.parse_soft_filters(text) == expected
