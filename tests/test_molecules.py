"""Molecule building against a sequential walk, with keys cut over many partitions."""

import random

import pytest

from tagweave.operators import molecules as mol

SCHEMA = "rname string, bx string, start bigint, `end` bigint, qname string, flag int, mapq int, mi bigint"


def walk(reads, window, band):
    """(key, start, end, name) -> molecule start or None, one read after the other."""
    placed, state = {}, {}
    for chrom, bx, start, end, name in sorted(set(reads)):
        current = state.get((chrom, bx))
        if current is None or current["stop"] + window < start:
            state[(chrom, bx)] = {"at": start, "stop": end, "names": {name}}
            placed[(chrom, bx, start, end, name)] = start
            continue
        gap = current["stop"] - start
        if band is None or name in current["names"] or gap < 0 or band[0] <= gap <= band[1]:
            current["stop"] = max(current["stop"], end)
            current["names"].add(name)
            placed[(chrom, bx, start, end, name)] = current["at"]
        else:
            placed[(chrom, bx, start, end, name)] = None
    return placed


def sample(seed, reach, names):
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        bx = "hot" if rng.random() < 0.7 else f"b{rng.randrange(12)}"
        start = rng.randrange(reach)
        rows.append(("c1", bx, start, start + rng.randrange(20, 60), f"n{rng.randrange(names)}"))
    return rows


@pytest.mark.parametrize("seed,reach,names", [(1, 6000, 900), (2, 2000, 60), (3, 60000, 300)])
def test_strict_equals_walk_over_partitions(spark, seed, reach, names):
    rows = sample(seed, reach, names)
    df = spark.createDataFrame([(*r, 0, 60, None) for r in rows], SCHEMA)
    expected = walk(rows, 100, (8, 10))
    placed = mol.strict_placements(df, ["rname", "bx"], 100, (8, 10), partitions=9)
    got = {(r.rname, r.bx, r.start, r.end, r.qname): r.mol_start for r in placed.collect()}
    assert got == expected


@pytest.mark.parametrize("seed,reach,wide", [(4, 3000, 0), (5, 80000, 0), (4, 3000, 10**6), (5, 80000, 10**6), (6, 9000, 10**6)])
def test_permissive_equals_walk(spark, monkeypatch, seed, reach, wide):
    monkeypatch.setattr(mol, "SCAN_WIDTH", 64)
    monkeypatch.setattr(mol, "WIDE_WINDOW", wide)
    rows = sample(seed, reach, 10**6)
    df = spark.createDataFrame([(*r, 0, 60, None) for r in rows], SCHEMA)
    expected = walk(rows, 100, None)
    placed = mol.permissive_placements(df, ["rname", "bx"], 100)
    got = {(r.rname, r.bx, r.start): r.mol_start for r in placed.collect()}
    assert got == {(k[0], k[1], k[2]): v for k, v in expected.items()}
    built = mol.build_molecules(df, "10x", 100, 1).collect()
    for m in built:
        members = [r for r in rows if (r[1], expected[r]) == (m.bx, m.StartPosition)]
        bases = set()
        for r in members:
            bases.update(range(r[2], r[3]))
        assert (m.Reads, m.BpCovered, m.EndPosition) == (len(members), len(bases), max(r[3] for r in members))


def test_unusable_reads_are_left_out(spark):
    rows = [("c", "b", 1, 50, "x", 1024, 60, None), ("c", "b", 1, 50, "y", 4, 60, None), ("c", "b", 1, 50, "z", 0, 3, None),
            ("c", "", 1, 50, "w", 0, 60, None), ("c", None, 1, 50, "v", 0, 60, None), ("c", "b", 1, 50, "u", 0, 60, None)]
    built = mol.build_molecules(spark.createDataFrame(rows, SCHEMA), "10x", 100, 1, 10).collect()
    assert [(m.Reads, m.Length) for m in built] == [(1, 49)]


def test_tag_of_a_name_in_two_molecules_is_the_last(spark):
    rows = [("c1", "b", 0, 50, "p", 0, 60, None), ("c1", "b", 60, 90, "q", 0, 60, None),
            ("c1", "b", 5000, 5050, "p", 0, 60, None), ("c1", "b", 5060, 5090, "r", 0, 60, None),
            ("c1", "b", 5060, 5090, "r", 1024, 60, None), ("c1", "b", 9000, 9001, "s", 0, 60, None)]
    tagged = mol.tag_reads(spark.createDataFrame(rows, SCHEMA), "10x", 100, 2)
    assert sorted((r.qname, r.mi) for r in tagged.collect()) == [("p", 5000), ("p", 5000), ("q", 0), ("r", 5000), ("r", 5000), ("s", -1)]


def test_no_limit_means_no_crowded_barcodes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "bx string")
    assert mol.crowded_barcodes(df, 0).count() == 0
    assert [r.bx for r in mol.crowded_barcodes(df, 1).collect()] == ["a"]


def test_strict_rounds_do_not_grow_with_partitions(spark, monkeypatch):
    """One key over 16 partitions: states are handed on in one walk, so a few rounds are enough."""
    rng = random.Random(12)
    starts = sorted(rng.randrange(400_000) for _ in range(4000))
    rows = [("c", "b", s, s + rng.choice([30, 50, 120]), f"n{rng.randrange(3000)}") for s in starts]
    reads = spark.createDataFrame(rows, "rname string, bx string, start long, end long, qname string")
    written = []
    real = mol.checkpointed
    monkeypatch.setattr(mol, "checkpointed", lambda df: written.append(1) or real(df))
    got = {}
    for partitions in (1, 16):
        written.clear()
        placed = mol.strict_placements(reads, ["rname", "bx"], 30000, (8, 10), partitions)
        got[partitions] = sorted(map(str, placed.select("start", "end", "qname", "mol_start").collect()))
    assert got[1] == got[16]
    assert len(written) <= 8
