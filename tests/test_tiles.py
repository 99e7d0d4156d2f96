"""Votes summed tile by tile: crowded tiles, small batches, and what is moved."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_haplotag import draw, frames, plain_fragments, plain_tags, shown_rows, units

from tagweave.operators import haplotag as hap
from tagweave.operators import tiles
from tagweave.operators import variants as va


@pytest.fixture
def crowded(spark, monkeypatch):
    """Tiles of 64 positions, many shares of each, and seven rows a batch."""
    for name, value in (("TILE", 64), ("SHARE_READS", 5), ("BARCODE_SHARES", 3)):
        monkeypatch.setattr(tiles, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed,distance", [(11, 60), (12, 5), (13, None)])
def test_tags_of_crowded_tiles(spark, crowded, seed, distance):
    reads, variants = draw(seed)
    rows, sites = frames(spark, reads, variants)
    got = hap.haplotag(rows, sites, distance, indels=True).select("qname", "start", "cigar", "bx", "hp", "ps", "pc").collect()
    tags = plain_tags(reads, variants, distance)
    assert shown_rows(got) == shown_rows((r["qname"], r["start"], r["cigar"], r["bx"], *t) for r, t in zip(reads, tags, strict=True))


@pytest.mark.parametrize("seed,distance", [(14, 60), (15, 0)])
def test_fragments_of_crowded_tiles(spark, crowded, seed, distance):
    reads, variants = draw(seed)
    choose = random.Random(seed)
    reads = [r | {"qname": None if choose.random() < 0.2 else r["qname"]} for r in reads]
    rows, sites = frames(spark, reads, variants)
    linked = {(r.rname, r.bx, r.unit): [tuple(b) for b in r.blocks] for r in hap.linked_fragments(rows, sites, distance, indels=True).collect()}
    assert linked == plain_fragments(reads, variants, distance)
    single = {(r.rname, r.qname): [tuple(b) for b in r.blocks] for r in hap.long_read_fragments(rows, sites).collect()}
    assert single == plain_fragments(reads, variants, None, long=True) and single


def test_fragments_move_reads_once_and_no_single_sites(spark):
    """Six reads of 400 sites each: what is moved are reads, sites and one row a molecule, not a row a vote."""
    n = 400
    reads = [(f"q{k}", 0, "c", 0, n, 60, f"{n}M", "A" * n, "I" * n, f"b{k % 2}") for k in range(6)]
    rows = spark.createDataFrame(reads, "qname string, flag int, rname string, start long, end long, mapq int, cigar string, sequence string, quality string, bx string")
    variants = [("c", p, "A", ["C"], [0, 1], True, 0) for p in range(n)]
    sites = spark.createDataFrame(variants, "chrom string, pos long, ref string, alts array<string>, gt array<int>, phased boolean, ps long")
    found = hap.linked_fragments(rows, sites, 300)
    assert {r.bx: (r.variants, r.blocks[0].qualities) for r in found.collect()} == {f"b{k}": (n, chr(33 + 93) * n) for k in (0, 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "inline" not in plan
    # Behind the first pass there is a row a barcode and slot, and one for the name that a batch ends in.
    chosen = rows.withColumn(tiles.GROUP, F.col("bx"))
    packed = tiles.allele_runs(chosen, hap._fragment_sites(sites, False), 300, 1 << 14)
    assert packed.count() <= 3 and packed.agg(F.sum("n")).first()[0] >= 2 * n


def test_molecules_are_the_same_after_merging(spark, crowded):
    reads, _ = draw(16)
    rows, _ = frames(spark, reads, [])
    for distance in (0, 5, 60):
        got = {(r.rname, r.bx, r.unit) for r in hap._molecules(rows, distance).collect()}
        want = units(reads, distance)
        assert got == {(reads[k]["rname"], reads[k]["bx"], u) for k, u in want.items()}


def test_numbers_of_runs_take_the_bytes_they_need():
    values = np.array([0, 1, 255, 0, 256, 0, 1 << 40, 7])
    runs = np.array([0, 3, 5])
    width, texts = tiles._narrow(values, runs, False)
    assert width.tolist() == [1, 2, 8] and [len(t) for t in texts] == [3, 4, 24]
    signed, back = tiles._narrow(-values, runs, True)
    assert signed.tolist() == [2, 2, 8]
    assert tiles._wide(tiles.pa.array(back), signed, np.array([3, 2, 3]), True).tolist() == (-values).tolist()


def test_records_are_numbered_by_place(spark):
    rows = [("c", p, r, [a]) for p in (5, 1 << 20, (1 << 20) + 1, 7) for r, a in (("A", "T"), ("A", "C"))] + [("d", 3, "A", ["C"]), (None, 1, "A", ["C"]), ("d", None, "A", ["C"])]
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, alts array<string>")
    got = {(r.chrom, r.pos, r.alts[0]): r.idx for r in va.index_variants(df).collect()}
    order = sorted(("c", p, a) for p in (5, 7, 1 << 20, (1 << 20) + 1) for a in ("C", "T"))
    assert got == {key: k for k, key in enumerate(order, 1)} | {("d", 3, "C"): 1}
