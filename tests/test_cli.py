"""Subcommands end to end on small files."""

import pytest

from tagweave import cli
from tagweave.sources import genomics


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    return lambda *args: cli.main([str(a) for a in args])


@pytest.fixture
def sam(tmp_path):
    lines = []
    for bx in ("AAAA", "CCCC"):
        for i, at in enumerate((100, 400, 900)):
            lines.append(f"{bx}{i}_BX:Z:{bx}-1\t67\tchrA\t{at}\t60\t50M\t=\t{at + 150}\t200\tA\tF")
            lines.append(f"{bx}{i}_BX:Z:{bx}-1\t147\tchrA\t{at + 150}\t60\t50M\t=\t{at}\t-200\tA\tF")
    (tmp_path / "in.sam").write_text("\n".join(lines) + "\n")
    return tmp_path / "in.sam"


def text(path):
    return [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]


def test_alignment_tools(run, spark, sam, tmp_path):
    run("tagbam", sam, "-o", tmp_path / "tagged.parquet", "-s", 2)
    assert {r.bx for r in spark.read.parquet(str(tmp_path / "tagged.parquet")).collect()} == {"AAAA-2", "CCCC-2"}
    run("find_clusterdups", tmp_path / "tagged.parquet", "--output-merges", tmp_path / "merges", "-l", "10x")
    assert text(tmp_path / "merges") == ["CCCC-2,AAAA-2"]
    run("merge_clusterdups", tmp_path / "tagged.parquet", tmp_path / "merges", "-o", tmp_path / "merged.parquet")
    run("buildmolecules", tmp_path / "merged.parquet", "-o", tmp_path / "mol", "-l", "10x", "-s", tmp_path / "stats", "--bed", tmp_path / "bed")
    reads = genomics.read_sam(spark, str(tmp_path / "mol")).collect()
    assert len(reads) == 12 and {r.mi for r in reads} == {1} and {r.bx for r in reads} == {"AAAA-2"}
    assert text(tmp_path / "stats")[-1] == "1\tAAAA-2\t12\t1000\t300"
    assert text(tmp_path / "bed") == ["chrA\t99\t1099\t1\tAAAA-2\tReads=12;Length=1000;BpCovered=300"]
    run("readmolecules", tmp_path / "mol", "-o", tmp_path / "again", "-l", "10x")
    assert text(tmp_path / "again")[-1] == "1\tAAAA-2\t12\t1000\t300"
    (tmp_path / "bad.txt").write_text("AAAA-2\n")
    run("filterclusters", tmp_path / "merged.parquet", tmp_path / "bad.txt", "-o", tmp_path / "kept.parquet")
    assert {(r.bx, r.qname[-9:]) for r in spark.read.parquet(str(tmp_path / "kept.parquet")).collect()} == {(None, "_FILTERED")}
    run("get", tmp_path / "tagged.parquet", "BX", "CCCC-2", "none", "-o", tmp_path / "got.parquet")
    assert spark.read.parquet(str(tmp_path / "got.parquet")).count() == 6


def test_barcode_tools(run, spark, tmp_path, capsys):
    seqs = ["AAAA", "AAAA", "AAAT", "GGGG", "GGGG", "CTCT"]
    (tmp_path / "bc.fastq").write_text("".join(f"@r{i} x\n{s}\n+\nFFFF\n" for i, s in enumerate(seqs)))
    (tmp_path / "r.fastq").write_text("".join(f"@r{i} {k}:N\nAC\n+\nFF\n" for i in range(6) for k in (1, 2)))
    run("correctbc", tmp_path / "bc.fastq", "-o", tmp_path / "clusters")
    assert text(tmp_path / "clusters") == ["AAAA\t3\tAAAA,AAAT", "GGGG\t2\tGGGG", "CTCT\t1\tCTCT"]
    run("tagfastq", tmp_path / "bc.fastq", tmp_path / "clusters", tmp_path / "r.fastq", "-o", tmp_path / "plain", "--min-count", 2)
    names = {r.value for r in spark.read.text(str(tmp_path / "plain/r1")).collect() if r.value.startswith("@")}
    assert "@r2_RX:Z:AAAT_BX:Z:AAAA 1:N" in names and "@r5 1:N" in names and len(names) == 6
    shown = {line[:40].strip(): line[40:].strip() for line in capsys.readouterr().out.splitlines()}
    assert shown["Read pairs"] == "6" and shown["Read pairs missing barcode"] == "1" and shown["Clusters"] == "3"
    run("tagfastq", tmp_path / "bc.fastq", tmp_path / "clusters", tmp_path / "r.fastq", "-o", tmp_path / "other", "-b", "CB", "-s", "CR")
    assert "@r2_CR:Z:AAAT_CB:Z:AAAA 1:N" in {r.value for r in spark.read.text(str(tmp_path / "other/r1")).collect()}
    run("tagfastq", tmp_path / "bc.fastq", tmp_path / "clusters", tmp_path / "r.fastq", "-o", tmp_path / "binned", "-m", "lariat", "--nr-bins", 2)
    binned = spark.read.text(str(tmp_path / "binned/bins")).collect()
    assert len(binned) == 6 * 9 and {r.bin for r in binned} <= {0, 1}


def test_indexed_reads(run, spark, tmp_path):
    (tmp_path / "s.fastq").write_text("".join(f"@r{i}#{ix}/{k}\nAC\n+\nFF\n" for i, ix in enumerate(["5_6_7", "0_0_0", "1_1_1", "5_6_7"]) for k in (1, 2)))
    run("process_stlfr", tmp_path / "s.fastq", "-o", tmp_path / "out", "--output-translations", tmp_path / "t")
    assert sorted(text(tmp_path / "t")) == ["1_1_1," + "A" * 15 + "C", "5_6_7," + "A" * 15 + "T"]
    names = {r.value for r in spark.read.text(str(tmp_path / "out/r2")).collect() if r.value.startswith("@")}
    assert names == {"@r1", "@r0_BX:Z:" + "A" * 15 + "T", "@r3_BX:Z:" + "A" * 15 + "T", "@r2_BX:Z:" + "A" * 15 + "C"}
    run("process_stlfr", tmp_path / "s.fastq", "-o", tmp_path / "bins", "-m", "ema", "--nr-bins", 2)
    rows = spark.read.text(str(tmp_path / "bins/bins")).collect()
    assert len(rows) == 3 and {r.bin for r in rows} == {0, 1}
    assert sorted(r.value for r in rows)[0] == "A" * 15 + "C @r2 AC FF AC FF"
    run("process_stlfr", tmp_path / "s.fastq", "-o", tmp_path / "nine", "-m", "lariat", "--nr-bins", 2)
    rows = spark.read.text(str(tmp_path / "nine/bins")).collect()
    assert len(rows) == 3 * 9 and {r.bin for r in rows} <= {0, 1}


def test_other_barcode_tag(run, spark, tmp_path):
    line = "r_BX:Z:AC_CB:Z:{}\t67\tchrA\t{}\t60\t50M\t=\t300\t200\tA\tF\tBX:Z:old\tCB:Z:GGG-1"
    (tmp_path / "in.sam").write_text("\n".join(line.format(b, at) for b, at in (("TT", 100), ("GG", 400))) + "\n")
    run("tagbam", tmp_path / "in.sam", "-o", tmp_path / "out", "-b", "CB", "-s", 2)
    rows = genomics.read_sam(spark, str(tmp_path / "out")).orderBy("start").collect()
    assert [(r.qname, r.bx, r.tags["CB"]) for r in rows] == [("r", "AC", "Z:TT-2"), ("r", "AC", "Z:GG-2")]


def test_settings_tool(run, tmp_path, capsys):
    (tmp_path / "a.yaml").write_text("x: 1\n")
    run("config", "-f", tmp_path / "a.yaml", "-s", "x", "5")
    run("config", "-f", tmp_path / "a.yaml")
    assert "x: 5" in capsys.readouterr().out
