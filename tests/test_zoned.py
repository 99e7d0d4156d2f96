"""Zoned tables: what regions read, and which files."""

import random

from pyspark.sql import functions as F

from tagweave.sources import zoned

SCHEMA = "id long, chrom string, start long, end long"


def overlapping(rows, regions):
    return sorted(i for i, c, s, e in rows if s is not None and any(c == d and s < y and x < e for d, x, y in regions))


def test_two_far_regions_read_two_files(spark, tmp_path):
    rows = [(k, c, s, s + 150) for k, (c, s) in enumerate((c, s) for c in ("chr1", "chr2") for s in range(0, 200_000_000, 50_000))]
    zoned.write_zoned(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), files=40)
    regions = [("chr1", 1_000_000, 1_100_000), ("chr2", 190_000_000, 190_050_001)]
    found = zoned.read_regions(spark, str(tmp_path / "t"), spark.createDataFrame(regions, "chrom string, start long, end long"))
    assert sorted(r.id for r in found.collect()) == overlapping(rows, regions)
    whole = len(spark.read.parquet(str(tmp_path / "t/rows")).inputFiles())
    # Each region lies in one narrow zone or two; a coarse zone of its chromosome may stand in another file.
    assert whole == 40 and len(found.inputFiles()) <= 6


def test_any_intervals(spark, tmp_path):
    choose = random.Random(3)
    rows = [(0, "a", None, None), (1, None, 5, 9), (2, "a", 0, 1 << 33), (3, "a", 7, 7)]
    for k in range(4, 400):
        start = choose.randrange(0, 1 << choose.choice([10, 18, 24, 31]))
        rows.append((k, choose.choice("ab"), start, start + choose.randrange(1, 1 << choose.choice([5, 17, 21, 30]))))
    rows.append(rows[10])
    zoned.write_zoned(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "t"), files=7)
    for k in range(6):
        regions = []
        for _ in range(k):
            start = choose.randrange(0, 1 << choose.choice([10, 18, 24, 31]))
            regions.append((choose.choice("abc"), start, start + choose.randrange(1, 1 << choose.choice([3, 20, 28]))))
        frame = spark.createDataFrame(regions, "chrom string, start long, end long")
        assert sorted(r.id for r in zoned.read_regions(spark, str(tmp_path / "t"), frame, width=1 << 24).collect()) == overlapping(rows, regions)


def test_zones_hold_their_intervals(spark):
    rows = [(0, 1), (0, 1 << 17), (0, (1 << 17) + 1), ((1 << 20) - 1, (1 << 20) + 1), (5, (1 << 29) + 9), (1 << 30, (1 << 30) + 1)]
    frame = spark.createDataFrame(rows, "start long, end long").withColumn("zone", zoned.zone(F.col("start"), F.col("end")))
    got = [r.zone for r in frame.collect()]
    assert got[0] == got[1] == zoned._first_of(0) and got[2] == zoned._first_of(1) and got[3] == zoned._first_of(2)
    assert got[4] == 0 and got[5] == zoned._first_of(0) + (1 << 13)
