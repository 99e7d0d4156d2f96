"""Text formats, reports, sinks, settings, streaming and whole flows."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from tagweave import config
from tagweave.operators import barcodes as bc
from tagweave.operators import molecules as mol
from tagweave.plans import haplotypes, linked_reads, tagging
from tagweave.sinks import layouts, tables as sink_tables
from tagweave.sources import genomics, lines, reports, sequences, tables
from tagweave.streaming import molecules as stream


def numbered(spark, text, path="example.txt"):
    rows = [(path, i, line) for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "path string, line_no bigint, line string")


def test_lines_are_numbered_over_splits(spark, tmp_path):
    text = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "big.txt").write_text("\n".join(text) + "\n")
    (tmp_path / "small.txt").write_text("one\ntwo\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = lines.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    big = {r.line_no: r.line for r in rows if r.path.endswith("big.txt")}
    assert [big[i] for i in range(3000)] == text
    assert sorted((r.line_no, r.line) for r in rows if r.path.endswith("small.txt")) == [(0, "one"), (1, "two")]


def test_fastq_files(spark, tmp_path):
    for side in (1, 2):
        with gzip.open(tmp_path / f"reads.{side}.fastq.gz", "wt") as f:
            for i in range(20):
                f.write(f"@r{i} {side}:N\nACG{'T' * i}\n+\n@@@{'F' * i}\n")
    first = str(tmp_path / "reads.1.fastq.gz")
    second = str(tmp_path / "reads.2.fastq.gz")
    pairs = sequences.read_fastq_pairs(spark, first, second)
    rows = {r.name: r for r in pairs.collect()}
    assert len(rows) == 20 and rows["r3 1:N"].name2 == "r3 2:N" and rows["r3 1:N"].r2_qual == "@@@FFF"
    out = str(tmp_path / "out")
    layouts.write_barcode_split(pairs.withColumn("barcode", F.when(F.col("record") % 2 == 0, "AC")), out)
    again = sequences.read_fastq_pairs(spark, f"{out}/barcoded")
    assert again.count() == 10
    layouts.write_fastq_pairs(pairs, str(tmp_path / "pairs"))
    assert sequences.read_fastq(spark, str(tmp_path / "pairs/r2")).count() == 20


def test_fastq_folders(spark, tmp_path):
    """Two folders of two files whose records are numbered anew: files pair by their order, and sides stay in step when written."""
    for side in (1, 2):
        (tmp_path / f"in{side}").mkdir()
        for part in "ab":
            text = "".join(f"@{part}{i} {side}\n{'ACGT'[i % 4] * (side + i % 3)}\n+\n{'F' * (side + i % 3)}\n" for i in range(50))
            (tmp_path / f"in{side}" / f"{part}.fastq").write_text(text)
    pairs = sequences.read_fastq_pairs(spark, str(tmp_path / "in1"), str(tmp_path / "in2"))
    rows = pairs.collect()
    assert len(rows) == 100 and all(r.name.split()[0] == r.name2.split()[0] for r in rows)
    assert len({r.place for r in rows}) == 100
    layouts.write_fastq_pairs(pairs, str(tmp_path / "out"), None)
    sides = [[p.read_text().splitlines()[::4] for p in sorted((tmp_path / "out" / s).glob("part-*"))] for s in ("r1", "r2")]
    assert [[n.split()[0] for n in part] for part in sides[0]] == [[n.split()[0] for n in part] for part in sides[1]]
    assert sum(map(len, sides[0])) == 100


def test_fasta(spark):
    got = sequences.parse_fasta(numbered(spark, ">a first one\nACG\nTT\n>b\nGG")).collect()
    assert {(r.name, r.comment, r.sequence) for r in got} == {("a", "first one", "ACGTT"), ("b", None, "GG")}


def test_fai_and_bed(spark):
    text = "chrA\t50000\t6\t60\t61\n\nchrB\t40000\t50\t60\t61\n"
    assert [tuple(r) for r in genomics.parse_fai(numbered(spark, text)).collect()] == [("chrA", 50000), ("chrB", 40000)]
    assert [tuple(r) for r in genomics.parse_bed(numbered(spark, "#c\nchrA\t0\t10\tx")).collect()] == [("chrA", 0, 10)]


def test_sam(spark):
    text = "@HD\tVN:1.6\nr1\t99\tchrA\t11\t60\t5S10M2D3I5M\t=\t101\t150\tACGT\tFFFF\tBX:Z:AC-1\tMI:i:7\tNM:i:0\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tF"
    rows = genomics.parse_sam(numbered(spark, text)).collect()
    assert (rows[0].start, rows[0].end, rows[0].bx, rows[0].mi, rows[0].mate_start) == (10, 27, "AC-1", 7, 100)
    assert rows[0].tags == {"NM": "i:0"} and rows[1].rname is None and rows[1].start is None


def test_vcf(spark):
    text = ("##contig=<ID=chrA,length=50000>\n##contig=<ID=chrB>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts\n"
            "chrA\t10\t.\tA\tC,G\t30.5\tPASS\tDP=5;DB\tGT:PS\t0|2:7\nchrA\t20\trs1\tAT\tA\t.\tq1;q2\t.\tGT\t0/1\nchrA\t30\t.\tA\tC\t1\t.\t.\tDP:GT\t3:.")
    rows = genomics.parse_vcf(numbered(spark, text)).collect()
    assert (rows[0].pos, rows[0].alts, rows[0].gt, rows[0].phased, rows[0].ps, rows[0].qual) == (9, ["C", "G"], [0, 2], True, 7, 30.5)
    assert rows[1].phased is False and rows[1].ps is None and rows[1].filter == ["q1", "q2"] and rows[1].qual is None
    assert rows[2].gt == [None] and rows[0].info["DP"] == "5"
    assert [tuple(r) for r in genomics.vcf_contig_lengths(numbered(spark, text)).collect()] == [("chrA", 50000)]


def test_structural_calls(spark):
    text = ("Chr1\tBreak1\tChr2\tBreak2\tSplit molecules\tDiscordant reads\tOrientation\tHaplotype\tScore\tPass filter\n"
            "22\t36746940\t22\t36751965\t40.0\t0.0\t+-\t3,3\t258.872434847\tPASS\n22\t65743624\t22\t65783121\t33.0\t3.0\t--\t2,2\t41.24\tFAIL")
    rows = genomics.parse_sv_calls(numbered(spark, text)).collect()
    assert [(r.break2, r.split_molecules, r.filter) for r in rows] == [(36751965, 40, "PASS"), (65783121, 33, "FAIL")]


def test_phase_text(spark):
    rows = genomics.parse_phase_blocks(numbered(spark, "BLOCK: offset: 6 len: 4 phased: 2 SPAN: 23514 fragments 1\n6\t0\t1\tx")).collect()
    assert [tuple(r) for r in rows] == [(4, 2, 23514, 1)]


LOG = """SETTINGS FOR: example
===================================================
STATS SUMMARY - some.package.example
---------------------------------------------------
Total reads                                  20,088
Unmapped reads                                1,321
Non analyced reads                            4,010
Duplicates                                    2,561
===================================================
Trailing                                      9,999"""


def test_run_log(spark):
    text = numbered(spark, LOG)
    assert reports.tool_names(text).first().tool == "example"
    assert {r.parameter: r.value for r in reports.parse_run_log(text).collect()} == {
        "total_reads": 20088.0, "unmapped_reads": 1321.0, "non_analyced_reads": 4010.0, "duplicates": 2561.0}


def test_sectioned_reports(spark):
    text = numbered(spark, "# c\nSN\tBarcodes final\t312101\nMB\t1\t87\nMB\t2\t10\nMB\t3\t3\nRB\t1\t401\t401\t0.5\nRB\t2\t3\t6\t0.25\nCB\t1\t542\nCB\t2\t3")
    assert [(r.parameter, r.value) for r in reports.summary_numbers(text).collect()] == [("barcodes_final", 312101.0)]
    assert {r.bin: r.percent for r in reports.section_percent(text, "MB").collect()} == {1.0: 87.0, 2.0: 10.0, 3.0: 3.0}
    assert {r.bin: r.percent for r in reports.section_percent(text, "CB").collect()}[1.0] == pytest.approx(99.44954128440367)
    assert {r.reads: r.percent for r in reports.density_percent(text).collect()} == {1: 50.0, 2: 25.0}
    points = reports.section_percent(text, "MB")
    assert reports.plot_limit(points, "bin", "percent", 0.99, 10).first().xmax == 10


def test_phasing_report(spark):
    text = numbered(spark, "switch rate:        0.5\n----------- chrA -----------\nswitch rate:        n/a\nN50:                664244\n----------- All -----------\nN50:  7")
    assert {(r.chrom, r.metric): r.value for r in reports.parse_phasing_report(text).collect()} == {
        ("All", "switch rate"): 0.5, ("chrA", "N50"): 664244.0, ("All", "N50"): 7.0}


def test_curves_and_haplotag(spark):
    assert [tuple(r) for r in reports.parse_curves(numbered(spark, "# c\nNX\t0\t17.5")).collect()] == [("example.txt", "NX", 0, 17.5)]
    text = "Found 1: samples\n\n== SUMMARY ==\nTotal alignments processed:                      8380\nAlignments that could be tagged:                  725\nhaplotag - total processing time: 0.1"
    got = {r.parameter: r.value for r in reports.parse_haplotag_log(numbered(spark, text)).collect()}
    assert got == {"Total alignments processed": 8380.0, "Alignments that could be tagged": 725.0, "% tagged": pytest.approx(8.651551312649165)}


def test_phased_share(spark):
    rows = [("s", "chrA", 24637, 17427, 19557, 16156, 15967), ("s", "ALL", 86276, 51777, 62953, 49132, 48662)]
    stats = spark.createDataFrame(rows, "sample string, chromosome string, variants long, phased long, heterozygous_variants long, heterozygous_snvs long, phased_snvs long")
    assert reports.phased_snv_share(stats).first().percent_snvs_phased == pytest.approx(98.83015597920277)
    whole = reports.genome_rows(stats).first()
    assert whole.percent_snvs_phased == pytest.approx(99.04339330782382) and whole.percent_variants_phased == pytest.approx(82.24707321334964)


def test_tables_round_trip(spark, tmp_path):
    clusters = spark.createDataFrame([("AA", 1, ["AA"]), ("CC", 9, ["CC", "CA"])], "canonical string, size bigint, components array<string>")
    sink_tables.write_clusters(clusters, str(tmp_path / "c"))
    assert {(r.canonical, r.size, tuple(r.components)) for r in tables.read_clusters(spark, str(tmp_path / "c")).collect()} == {
        ("AA", 1, ("AA",)), ("CC", 9, ("CC", "CA"))}
    labels = spark.createDataFrame([("a", "a"), ("b", "a")], "node string, label string")
    sink_tables.write_merges(labels, str(tmp_path / "m"))
    assert [tuple(r) for r in tables.read_merges(spark, str(tmp_path / "m")).collect()] == [("b", "a")]
    (tmp_path / "m1.tsv").write_text("MoleculeID\tBarcode\tReads\tLength\tBpCovered\n1\tx\t4\t100\t50\n")
    (tmp_path / "m2.tsv").write_text("other\n1\n")
    got = tables.read_molecules(spark, [str(tmp_path / "m2.tsv"), str(tmp_path / "m1.tsv")]).collect()
    assert [(r.Barcode, r.Length, r.FileNr) for r in got] == [("x", 100, 1)]
    (tmp_path / "words.txt").write_text("a b\n\nc a\n")
    assert sorted(r.bx for r in tables.read_words(spark, str(tmp_path / "words.txt")).collect()) == ["a", "b", "c"]
    assert sorted(r.value for r in tables.requested_values(spark, [str(tmp_path / "words.txt")]).collect()) == ["a b", "c a"]
    assert sorted(r.value for r in tables.requested_values(spark, ["1", "2"]).collect()) == ["1", "2"]


def test_summary_text(spark):
    df = spark.createDataFrame([("Reads", 20088.0), ("Share", 0.12345)], "parameter string, value double")
    assert [r.line.split() for r in sink_tables.summary_lines(df).collect()] == [["Reads", "20,088"], ["Share", "0.123"]]


def test_record_layouts(spark):
    df = spark.createDataFrame([("n", "AC", "FF", "GT", "KK", "ACGT")], "name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string, barcode string")
    row = df.select(layouts.bin_record().alias("b"), layouts.nine_line_record(2).alias("l"), layouts.bin_rows_to_fastq("other").alias("f")).first()
    assert row.b == "ACGT @n AC FF GT KK"
    assert row.l.split("\n") == ["@n", "AC", "FF", "GT", "KK", "ACGT-2", "KKKK", "AAAAAA", "KKKKKK"]
    assert row.f.split("\n")[0] == "@n_BX:Z:ACGT-1" and row.f.split("\n")[5] == "GT"


def test_settings(tmp_path):
    nested = {"foo": 3, "bar": 4, "nested": {"key": "new_value"}}
    assert config.flatten(nested) == {"foo": 3, "bar": 4, "nested.key": "new_value"}
    merged = dict(config.combined_changes([("bar", "1"), ("nested.key", "old_value")], nested))
    assert merged == {"foo": "3", "bar": "1", "nested.key": "old_value"}
    path = tmp_path / "run.yaml"
    path.write_text("a: 1\nb:\n  c: x\n")
    assert config.change_file(path, [("b.c", "null"), ("a", "2")]) == {"a": 2, "b": {"c": None}}
    assert config.absolute_path("plain.txt") == "plain.txt"
    assert config.fill_template(["#c\n", "k=1\n", "d=2\n", "\n"], {"k": 3, "d": None}) == ["#c\n", "k=3\n", "#d=2\n", "\n"]


def make_reads(spark, seed):
    rng = random.Random(seed)
    rows = [("q%d" % i, 0, "c", s, s + rng.randrange(5, 40), 60, "b%d" % rng.randrange(4)) for i, s in enumerate(rng.randrange(20000) for _ in range(300))]
    return spark.createDataFrame(rows, "qname string, flag int, rname string, start bigint, `end` bigint, mapq int, bx string")


def test_stream_equals_batch(spark, tmp_path):
    reads = make_reads(spark, 1)
    reads.write.parquet(str(tmp_path / "reads"))
    source = spark.readStream.schema(reads.schema).parquet(str(tmp_path / "reads"))
    query = (stream.stream_sessions(source, 200).writeStream.outputMode("complete").format("memory").queryName("molecules")
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    streamed = {tuple(r) for r in spark.table("molecules").select("rname", "bx", "StartPosition", "EndPosition", "Reads").collect()}
    batch = mol.build_molecules(reads, "10x", 200, 1).select("rname", "bx", "StartPosition", "EndPosition", "Reads")
    assert streamed == {tuple(r) for r in batch.collect()}


def test_linked_read_flow(spark):
    rows = []
    for pair, (bx, at) in enumerate(itertools_product(["b1", "b2"], [100, 400, 900, 1500, 2000])):
        rows.append((f"p{pair}", 67, "c", at, at + 50, 60, bx))
        rows.append((f"p{pair}", 147, "c", at + 150, at + 200, 60, bx))
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, start bigint, `end` bigint, mapq int, bx string")
    flow = linked_reads.linked_reads(reads, "10x", window=30000, min_reads=4)
    assert {r.node: r.label for r in flow.labels.collect()} == {"b1": "b1", "b2": "b1"}
    molecule = flow.molecules.collect()
    assert [(m.Barcode, m.Reads, m.Length, m.MoleculeID) for m in molecule] == [("b1", 20, 2100, 1)]
    assert {(r.bx, r.mi) for r in flow.reads.collect()} == {("b1", 100)}
    assert flow.statistics.first().barcodes_final == 1


def itertools_product(first, second):
    return [(a, b) for a in first for b in second]


def test_tagging_flow(spark, tmp_path):
    names = ["r%d" % i for i in range(8)]
    pairs = spark.createDataFrame([(n + " 1:N", "A", "F", n + " 2:N", "C", "F") for n in names],
                                  "name string, r1_seq string, r1_qual string, name2 string, r2_seq string, r2_qual string")
    raw = spark.createDataFrame([(n, ["AAAA", "AAAT", "TTTT"][i % 3]) for i, n in enumerate(names[:7])], "read_name string, raw_barcode string")
    clusters = spark.createDataFrame([("AAAA", 5, ["AAAA", "AAAT"]), ("TTTT", 2, ["TTTT"])], "canonical string, size bigint, components array<string>")
    plain = {r.name2: r.name for r in tagging.tag_pairs(pairs, raw, clusters).barcoded.collect()}
    assert plain["r1_RX:Z:AAAT_BX:Z:AAAA 2:N"] == "r1_RX:Z:AAAT_BX:Z:AAAA 1:N" and plain["r7 2:N"] == "r7 1:N"
    tagged = tagging.tag_pairs(pairs, raw, clusters, "ema", nr_bins=2)
    rows = tagged.barcoded.collect()
    assert len(rows) == 7 and tagged.other.count() == 1 and len({(r.barcode, r.heap, r.bin) for r in rows}) == 2
    layouts.write_bins(tagged.barcoded, str(tmp_path / "bins"), layouts.interleaved_record())
    assert sequences.read_fastq(spark, str(tmp_path / "bins" / "bin=0")).count() > 0


def test_vcf_comparison_flow(spark, tmp_path):
    head = "##contig=<ID=c,length=1000>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts\n"

    def vcf(path, flips):
        body = "".join(f"c\t{p * 10}\t.\tA\tC\t9\tPASS\t.\tGT:PS\t{'1|0' if (p >= 5) == flips else '0|1'}:10\n" for p in range(1, 11))
        path.write_text(head + body)
        return str(path)

    report, curves = haplotypes.compare_vcfs(spark, vcf(tmp_path / "a.vcf", True), vcf(tmp_path / "b.vcf", False))
    whole = {r.chrom: r for r in report.collect()}["All"]
    assert whole.n50 == 90 and whole.phased_count == 10 and whole.switch_count == 0
    assert {r.stat for r in curves.collect()} == {"NX", "ANX", "QNX", "QAN", "NGX", "QNG"}


def test_count_stream_shape(spark):
    rows = make_reads(spark, 2)
    assert sum(r.n for r in stream.stream_barcode_counts(rows).collect()) == 300
    assert bc.count_barcodes(rows, "bx").count() == 4


def test_merged_variants_are_in_contig_order(spark):
    from tagweave.operators import merging

    rows = [("chr2", 5), ("chr10", 1), ("chr2", 3), ("odd", 2), ("chr10", 9)]
    df = spark.createDataFrame(rows, "chrom string, pos long")
    contigs = spark.createDataFrame([("chr2", 0), ("chr10", 1)], "name string, nr int")
    got = merging.ordered_variants([df.where("pos < 4"), df.where("pos >= 4")], contigs).collect()
    assert [tuple(r) for r in got] == [("chr2", 3), ("chr2", 5), ("chr10", 1), ("chr10", 9), ("odd", 2)]


def test_lines_of_compressed_files_are_never_broadcast(spark, tmp_path):
    for side in (1, 2):
        (tmp_path / f"r{side}").mkdir()
        with gzip.open(tmp_path / f"r{side}" / "a.gz", "wt") as f:
            f.write("".join(f"@r{i}\nACGT\n+\nFFFF\n" for i in range(500)))
    pairs = sequences.read_fastq_pairs(spark, str(tmp_path / "r1"), str(tmp_path / "r2"))
    assert "SortMergeJoin [file" in pairs._jdf.queryExecution().executedPlan().toString()
    one = lines.numbered_lines(spark, str(tmp_path / "r1"))
    assert "BuildRight" in one._jdf.queryExecution().executedPlan().toString()
    assert pairs.where("r1_seq = 'ACGT' AND name = name2").count() == 500
