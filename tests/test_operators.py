"""Barcodes, components, bins, gaps, contigs and calls on small inputs."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagweave.functions import dna
from tagweave.operators import barcodes as bc
from tagweave.operators import editlinks
from tagweave.operators import components, contigs, duplicates, gaps, intervals, reads, statistics, structural


def column(spark, values, name="v", kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def test_iupac_template(spark):
    df = column(spark, ["ATCG", "GTCG", "ATC"])
    assert [r.m for r in df.select(dna.matches_template(F.col("v"), "AWVN").alias("m")).collect()] == [True, False, False]


def test_reverse_complement_keeps_unknown_bases(spark):
    assert column(spark, ["ACGTN"]).select(dna.reverse_complement(F.col("v")).alias("r")).first().r == "NACGT"


def test_cluster_map(spark):
    rows = [("AAAA", 3, ["AAAA", "AAAT"]), ("TTAA", 2, ["TTAG"]), ("CGTG", 1, ["CGTG"])]
    clusters = spark.createDataFrame(rows, "canonical string, size bigint, components array<string>")
    full = {r.raw_barcode: r.barcode for r in bc.barcode_map(bc.passing_clusters(clusters)).collect()}
    assert full == {"AAAA": "AAAA", "AAAT": "AAAA", "TTAG": "TTAA", "CGTG": "CGTG"}
    assert len(bc.barcode_map(bc.passing_clusters(clusters, 2)).collect()) == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_single_correction_brute_force(spark, seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(200):
        counts["".join(rng.choice("ACGTN" if rng.random() < 0.1 else "ACGT") for _ in range(4))] = rng.choice([1, 1, 2, 5])
    frame = spark.createDataFrame(list(counts.items()), "barcode string, n bigint")
    expected = {b: [n, {b}] for b, n in counts.items() if n > 1}
    for single in (b for b, n in counts.items() if n == 1):
        near = {single[:i] + base + single[i + 1:] for i in range(4) for base in "ACGT" if base != single[i]}
        hits = [b for b in near if counts.get(b, 0) > 1]
        if len(hits) == 1:
            expected[hits[0]][0] += 1
            expected[hits[0]][1].add(single)
        else:
            expected[single] = [1, {single}]
    got = {r.canonical: [r.size, set(r.components)] for r in bc.correct_singles(frame).collect()}
    assert got == expected


def test_edit_links_brute_force(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ACG") for _ in range(rng.randrange(4, 7))) for _ in range(60)})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    # Crowded segments: half of the words share most of their letters.
    words += ["AAAAAAAA" + w for w in words[:30]] + ["A", "", "AC"]
    counts = {w: rng.choice([1, 1, 1, 2, 3, 5, 9, 30]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "barcode string, n long")
    for max_dist, ratio in ((1, 2), (2, 3)):
        expected = {}
        for w in words:
            near = [(distance(w, x), -counts[x], x) for x in words if counts[x] >= ratio * counts[w] and abs(len(w) - len(x)) <= max_dist]
            near = [t for t in near if t[0] <= max_dist]
            if near:
                expected[w] = (min(near)[2], min(near)[0])
        for intact in (None, 1, 2, 3):
            found = editlinks.parent_links(frame, max_dist, ratio, intact).collect()
            assert {r.barcode: (r.parent, r.distance) for r in found} == expected
        root = {w: w for w in words}
        for w in words:
            while root[w] in expected:
                root[w] = expected[root[w]][0]
        size = {r: sum(counts[w] for w in words if root[w] == r) for r in set(root.values())}
        members = editlinks.cluster_members(frame, max_dist, ratio).collect()
        assert sorted(map(tuple, members)) == sorted((root[w], w, counts[w], size[root[w]]) for w in words)


def test_edit_links_of_empty_tables_and_key_lengths(spark):
    empty = spark.createDataFrame([], "barcode string, n long")
    assert editlinks.parent_links(empty).count() == 0 and editlinks.cluster_members(empty).count() == 0
    assert [editlinks.intact_segments(n, 20, 2) for n in (10, 10**6, 10**9)] == [1, 2, 3]


def test_bins_row_by_row(spark):
    rng = random.Random(7)
    heaps = [(h, rng.choice([1, 2, 3, 40])) for h in range(60)]
    total, nr_bins = sum(n for _, n in heaps), 7
    size, written, full, bin_nr, last, expected = total // nr_bins, 0, True, -1, None, {}
    for heap, n in heaps:
        for _ in range(n):
            if full and heap != last:
                full, bin_nr = False, bin_nr + 1
            last = heap
            expected[heap] = bin_nr
            written += 1
            if written > size:
                full, written = True, 0
    frame = spark.createDataFrame(heaps, "heap bigint, n bigint")
    assert {r.heap: r.bin for r in bc.pack_bins(frame, nr_bins, width=8).collect()} == expected


def test_heap_order_separates_prefixes(spark):
    rng = random.Random(9)
    heads = ["".join(p) for p in itertools.product("ACGT", repeat=3)][:12]
    words = sorted({h + "".join(rng.choice("ACGT") for _ in range(3)) for h in heads for _ in range(rng.randrange(1, 9))})
    order = bc.heap_order(column(spark, words, "canonical"), prefix=3, buckets=1).orderBy("heap").collect()
    assert [r.heap for r in order] == list(range(len(words)))
    shared = [a for a, b in zip(order, order[1:]) if a.canonical[:3] == b.canonical[:3]]
    alone = {r.canonical[:3] for r in order[-8:]}
    assert not shared or len(alone) < 8 and shared[0].heap > len(words) - 8


def test_generated_barcodes(spark):
    rows = spark.createDataFrame([(3, "1_2_3"), (1, "9_9_9"), (7, "1_2_3")], "at bigint, index string")
    got = {r["index"]: r.barcode for r in bc.generated_barcodes(rows, "index", "at", 4).collect()}
    assert got == {"9_9_9": "A" * 15 + "T", "1_2_3": "A" * 15 + "C"}


def test_indexed_names(spark):
    df = column(spark, ["x#1_2_21/1\tc", "x#1_2_2/1", "y#0_0_0/1", "z#4_5/1"], "name")
    assert [(r.read_name, r["index"]) for r in bc.parse_indexed_names(df).collect()] == [
        ("x", "1_2_21"), ("x", "1_2_2"), ("y", None), ("z", None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_against_union(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:03d}" for i in range(80)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(60)] + [("n000", n) for n in rng.sample(names, 20)]
    chain = [(names[i], names[i + 1]) for i in range(40, 70)]
    edges += chain
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(edges, "src string, dst string")
    assert {r.node: r.label for r in components.connected_components(frame).collect()} == root


def test_pairing_state(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "x", "y"]), i, rng.random() < 0.7) for i in range(120)]
    waiting, expected = {}, set()
    for name, i, good in rows:
        if name in waiting:
            expected.add((name, waiting.pop(name), i))
        elif good:
            waiting[name] = i
    frame = spark.createDataFrame(rows, "qname string, at bigint, good boolean")
    got = duplicates.paired_reads(frame, "at", F.col("good"), 16).select("qname", "mate_at", "read_at").collect()
    assert {tuple(r) for r in got} == expected


@pytest.mark.parametrize("library,band", [("dbs", {-8, -9, -10}), ("tellseq", {-4, -5, -6}), ("10x", None)])
def test_edges_brute_force(spark, library, band):
    rng = random.Random(11)
    rows = set()
    for _ in range(260):
        start = rng.randrange(400)
        rows.add(("c", start, start + rng.randrange(5, 30), rng.choice("FR"), f"b{rng.randrange(7)}"))
    seeds = spark.createDataFrame(sorted(rows), "rname string, start bigint, `end` bigint, orientation string, bx string")
    held = {}
    for c, s, e, o, b in rows:
        held.setdefault((s, e, o), set()).add(b)
    expected = set()
    for q, p in itertools.combinations(sorted(held), 2):
        gap = p[0] - q[1]
        if gap <= 25 and (band is None or gap >= 0 or gap in band):
            both = sorted(held[q] & held[p])
            if len(both) > 1:
                expected.update(itertools.combinations(both, 2))
    got = {(r.src, r.dst) for r in duplicates.barcode_edges(seeds, library, 25).collect()}
    assert got == expected


def test_names_to_tags(spark):
    bc20 = "TGTACTGCAATCGATCGATA"
    df = spark.createDataFrame([(f"r:1:2_BX:Z:{bc20}-1_RX:Z:{bc20}", None)], "qname string, bx string")
    assert reads.detect_mode(df) == "underline"
    row = reads.tags_from_names(df, "underline", 3).first()
    assert (row.qname, row.bx, row.rx) == ("r:1:2", f"{bc20}-3", bc20)
    many = spark.createDataFrame([(f"r{i}", None) for i in range(3000)] + [(f"last_BX:Z:{bc20}_UX:Z:ACGT_MI:Z:AC_CB:Z:TT", None)], "qname string, bx string")
    assert reads.detect_mode(many.coalesce(1)) == "underline"
    kept = many.withColumn("tags", F.create_map(F.lit("UX"), F.lit("Z:old"), F.lit("NM"), F.lit("i:0")))
    row = reads.tags_from_names(kept, "underline", name_tag="CB").where("qname = 'last'").first()
    assert (row.bx, row.rx) == ("TT-1", None)
    assert row.tags == {"NM": "i:0", "UX": "Z:ACGT", "BX": f"Z:{bc20}", "MI": "Z:AC"}
    df = spark.createDataFrame([(f"r:1:{bc20}", f"{bc20[:16]}-1"), ("plain:1", None)], "qname string, bx string")
    assert reads.detect_mode(df) == "trailing"
    rows = reads.tags_from_names(df, "trailing", 3).collect()
    assert [(r.qname, r.bx) for r in rows] == [("r:1", f"{bc20}-3"), ("plain:1", None)]
    assert reads.unique_program_id("tagbam", ["tagbam", "tagbam.1"]) == "tagbam.2"
    assert reads.detect_mode(column(spark, ["a", "b"], "qname").withColumn("bx", F.lit(None).cast("string"))) == "none"


def test_stripping(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("c", None, 3)], "qname string, bx string, mi int")
    rows = reads.strip_barcodes(df, column(spark, ["x"], "bx")).collect()
    assert sorted((r.qname, r.bx, r.mi) for r in rows if r.bx) == [("b", "y", 2)]
    assert ("a_FILTERED", None, None) in {tuple(r) for r in rows} and ("c", None, 3) in {tuple(r) for r in rows}


def test_contig_chunks():
    index = [("A", 500), ("B", 500), ("C", 10), ("D", 20), ("E", 150), ("F", 50)]
    names = [[n for n, _ in chunk] for chunk in contigs.contig_chunks(index, 100)]
    assert names == [["A"], ["B"], ["C", "D"], ["E"], ["F"]]
    assert len(contigs.contig_chunks([("A", 500), ("B", 500)], 1000)) == 1


def test_chunk_sets():
    index = [("A", 700), ("B", 400), ("C", 300), ("D", 200), ("E", 200), ("F", 100)]
    sets = contigs.chunk_sets(index, 1000, ["A", "B", "C"], "F")
    flat = {k: {n for chunk in v for n, _ in chunk} for k, v in sets.items()}
    assert flat["phased"] == set("ABC") and flat["primary"] == set("ABCDE") and flat["all"] == set("ABCDEF")
    assert flat["not_primary"] == {"F"} and flat["primary_not_phased"] == set("DE") and flat["not_phased"] == set("DEF")
    with pytest.raises(ValueError):
        contigs.chunk_sets(index, 1000, ["F"], "F")


def test_flank_regions(spark):
    rows = [("chr1_0-500-L", "+", 500, True), ("chr1_600-900-R", "+", 300, False), ("s1", "+", 100, True), ("s1", "-", 100, True), ("s2", "-", 40, False)]
    df = spark.createDataFrame(rows, "name string, orient string, slen bigint, is_left boolean")
    region = gaps.flank_region(F.col("name"), F.col("orient"), F.col("slen"), F.col("is_left"), 60)
    assert [tuple(r.r) for r in df.select(region.alias("r")).collect()] == [
        ("chr1", 440, 500), ("chr1", 600, 660), ("s1", 40, 100), ("s1", 1, 60), ("s2", 1, 40)]


def test_insert_names(spark):
    df = spark.createDataFrame([("chr1_0-13239699-L+:chr1_13239799-27878410-R+_fwd_1/1.k61", "_ len.1085_qual.AB")], "name string, comment string")
    r = gaps.parse_insert_names(df).first()
    assert (r.gap, r.chrom, r.gap_start, r.gap_end) == ("chr1_0-13239699-L+:chr1_13239799-27878410-R+", "chr1", 13239699, 13239799)
    assert (r.direction, r.kmer, r.length, r.quality) == ("fwd", "k61", 1085, "AB")


def test_calls(spark):
    schema = "chr1 string, break1 bigint, chr2 string, break2 bigint, orientation string, haplotype string, filter string"
    rows = [("22", 36746940, "22", 36751965, "+-", "3,3", "PASS"), ("1", 5, "2", 9, "-+", "1,2", "PASS"), ("1", 5, "1", 5, "??", "1,1", "PASS"), ("1", 1, "1", 1000, "++", "2,2", "FAIL")]
    calls = spark.createDataFrame(rows, schema)
    assert [(r.length, r.svtype, r.zygosity) for r in structural.annotate(calls).collect()] == [
        (5025, "DEL", "UNK"), (0, "DUP", "HET"), (0, "UNK", "HOM"), (999, "INV", "HOM")]
    table = {r.Size: (r.DEL, r.INV, r.DUP) for r in structural.size_table(calls).collect()}
    assert table["1k-10k"] == (1, 0, 0) and table["Interchrom"] == (0, 0, 1) and table["0-1k"] == (0, 0, 0) and len(table) == 8


def test_size_labels(spark):
    df = column(spark, [12, 999, 12345, 1234567], "n", "bigint")
    assert [r.s for r in df.select(intervals.size_label(F.col("n")).alias("s")).collect()] == ["12 bp", "1.0 kbp", "12.3 kbp", "1.2 Mbp"]


def test_chromosome_order(spark):
    df = column(spark, ["chrUn", "chr10", "chrX", "chr2", "chrM", "chrY"])
    assert [r.v for r in df.orderBy(statistics.chromosome_rank(F.col("v"))).collect()] == ["chr2", "chr10", "chrX", "chrY", "chrM", "chrUn"]


def test_lookups_of_alignments_do_not_depend_on_size(spark):
    """SAM reads hold a map; every tool that looks something up gives the same rows and columns, broadcast or not."""
    from tagweave.operators import molecules
    from tagweave.sources import genomics

    lines = [
        f"r{i % 30}\t{67 if i % 2 else 147}\tchr{i % 2}\t{100 + 37 * i}\t60\t50M\t=\t9\t1\tA\tF\tBX:Z:B{i % 5}\tMI:i:{i % 7}\tNM:i:{i}" for i in range(60)
    ]
    sam = genomics.parse_sam(column(spark, lines, "line"))
    labels = spark.createDataFrame([("B1", "B0"), ("B2", "B2")], "node string, label string")
    tools = {
        "strip": lambda: reads.strip_barcodes(sam, column(spark, ["B1", "B3"], "bx")),
        "retag": lambda: components.retag(sam, labels),
        "place dbs": lambda: molecules.place_reads(sam, "dbs"),
        "place 10x": lambda: molecules.place_reads(sam, "10x"),
        "tag": lambda: molecules.tag_reads(sam, "10x", min_reads=2),
        "values": lambda: statistics.rows_with_values(sam, "bx", column(spark, ["B4"], "value")),
        "duplicates": lambda: duplicates.mark_duplicates(sam, ["rname", "bx"], "mapq", "qname"),
        "sorted": lambda: reads.coordinate_sorted(sam, spark.createDataFrame([("chr1", 0), ("chr0", 1)], "name string, nr int")),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    seen = {}
    try:
        for bound in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
            for name, tool in tools.items():
                made = tool()
                found = (made.columns, sorted(map(str, made.collect())))
                assert seen.setdefault(name, found) == found, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(seen["strip"][1]) == 60 and seen["retag"][0] == sam.columns


def _component_sets(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("library", ["dbs", "tellseq", "10x"])
def test_droplet_links_have_the_components_of_all_pairs(spark, library):
    """Barcodes with few and with many positions in reach, whichever way they are looked up."""
    rng = random.Random(11)
    rows = set()
    for _ in range(260):
        start = rng.randrange(0, 1500)
        place = ("c", start, start + rng.randrange(20, 90), rng.choice("FR"))
        for bx in rng.sample([f"b{k:02d}" for k in range(30)], rng.choice([1, 2, 2, 3])) + (["hot"] if rng.random() < 0.6 else []):
            rows.add((*place, bx))
    frame = spark.createDataFrame(sorted(rows), "rname string, start long, end long, orientation string, bx string")
    expected = _component_sets(map(tuple, duplicates.barcode_edges(frame, library, 25).collect()))
    assert expected
    for crowd in (0, 3, 8, 1000):
        assert _component_sets(map(tuple, duplicates.droplet_links(frame, library, 25, crowd).collect())) == expected


@pytest.mark.parametrize("library", ["dbs", "10x"])
def test_droplet_links_write_rows_in_proportion(spark, library, monkeypatch):
    """One barcode at 5,000 positions of one window: less than ten rows are written for each that is given."""
    rows = [("c", k, k + 5000, "F", "hot") for k in range(5000)] + [("c", k, k + 5000, "F", f"b{k % 1500:04d}") for k in range(0, 5000, 2)]
    frame = spark.createDataFrame(rows, "rname string, start long, end long, orientation string, bx string")
    written = []

    def counted(df, keep=duplicates.checkpointed):
        held = keep(df)
        written.append(held.count())
        return held

    monkeypatch.setattr(duplicates, "checkpointed", counted)
    links = duplicates.droplet_links(frame, library, 30_000)
    found = {tuple(r) for r in links.collect()}
    assert sum(written) < 10 * len(rows)
    # Each of these barcodes is met at two or more of the positions that "hot" is at, all of which overlap.
    assert found == (set() if library == "dbs" else {(f"b{k:04d}", "hot") for k in range(0, 1500, 2)})


def test_edit_links_look_further_only_where_nothing_is_near(spark, monkeypatch):
    words = ["".join(w) for w in itertools.product("ACGT", repeat=5)]
    frame = spark.createDataFrame([(w, 9 if w[-1] == "A" else 1) for w in words] + [("GGGGGTTT", 1)], "barcode string, n long")
    searched, keys = {}, editlinks._keys

    def spied(rows, name, choices, max_dist, intact):
        if name == "barcode":
            searched[max_dist] = rows.count()
        return keys(rows, name, choices, max_dist, intact)

    monkeypatch.setattr(editlinks, "_keys", spied)
    found = editlinks.parent_links(frame, 2, 3).collect()
    assert {r.barcode for r in found} == {w for w in words if w[-1] != "A"} and {r.distance for r in found} == {1}
    assert searched[2] == 1


def test_overlaps_of_a_crowded_bin_are_dealt_over_tasks(spark):
    left = spark.createDataFrame([("c", i, i + 5) for i in range(400)], "chrom string, start long, end long")
    right = spark.createDataFrame([("c", i, i + 3) for i in range(400)], "chrom string, r_start long, r_end long")
    columns = ["start", "end", "r_start", "r_end"]
    pairs = intervals.overlap_join(left, right, 1 << 16, shares=8)
    rows = sorted(map(tuple, pairs.select(*columns).collect()))
    assert rows == [(s, s + 5, r, r + 3) for s in range(400) for r in range(400) if s < r + 3 and r < s + 5]
    assert set(pairs.columns) == {"chrom", *columns}
    assert pairs.select(F.spark_partition_id()).distinct().count() > 1


def test_flank_barcodes_are_counted_where_their_pairs_are_formed(spark):
    rng = random.Random(5)
    rows = [("c" if rng.random() < 0.7 else "d", s, s + rng.randrange(0, 60), f"b{0 if rng.random() < 0.3 else rng.randrange(9)}", 1024 if rng.random() < 0.1 else 0)
            for s in (rng.randrange(40000) for _ in range(900))]
    flanks = [(f"g{k % 20}", "c" if k % 3 else "d", s, s + rng.randrange(-1, 4000)) for k, s in enumerate(rng.randrange(1, 40000) for _ in range(40))]
    reads = spark.createDataFrame(rows, "rname string, start long, end long, bx string, flag int")
    regions = spark.createDataFrame(flanks, "gap string, contig string, start long, end long")
    want = Counter((g, bx) for g, contig, lo, hi in flanks for rname, s, e, bx, flag in rows if not flag and rname == contig and s < hi and lo - 1 < e)
    found = gaps.flank_barcodes(regions, reads, 2, width=1 << 10, task_pairs=100, part_flanks=15)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert {(r.gap, r.bx): r.occurrences for r in found.collect()} == {k: n for k, n in want.items() if n >= 2}
    # Spans are moved and flanks copied; their pairs are not moved.
    assert plan.count("BroadcastHashJoin") == 3 and plan.count("Exchange hashpartitioning") == 3
    assert "hashpartitioning(gap" not in plan and all("Exchange hashpartitioning(bx" in part for part in plan.split("HashAggregate")[2::2])


def test_pairs_are_read_once_for_their_seeds(spark):
    read = spark.sparkContext.accumulator(0)

    def told(place):
        read.add(1)
        return place

    rows = [("c", k % 30, k % 30 + 5, "F", f"b{k % 7}") for k in range(210)] + [("c", 500, 510, "F", "x"), ("c", 1, 6, "F", None)]
    pairs = spark.createDataFrame(rows, "rname string, start long, end long, orientation string, bx string")
    pairs = pairs.withColumn("start", F.udf(told, "long")("start"))
    seeds = {tuple(r) for r in duplicates.seed_positions(pairs, minimum=9).select("start", "bx").collect()}
    assert seeds == {(k % 30, f"b{k % 7}") for k in range(210)}
    assert read.value <= len(rows)
