"""Streams with state against their batch forms."""

import os
import random

import pytest

from tagweave.operators import molecules as mol
from tagweave.streaming import strict

SCHEMA = "qname string, flag int, rname string, start long, end long, mapq int, bx string"
COLUMNS = ["rname", "bx", "StartPosition", "EndPosition", "Reads", "Length", "BpCovered"]


def draw(n, seed, barcodes=6, reach=40_000):
    choose = random.Random(seed)
    rows = []
    for _ in range(n):
        start = choose.randint(0, reach)
        flag = choose.choice([0, 0, 0, 0, 0, 0, 4, 1024])
        barcode = None if choose.random() < 0.05 else f"b{choose.randint(0, barcodes)}"
        rows.append((f"q{choose.randint(0, n // 4)}", flag, choose.choice("xy"), start, start + choose.randint(1, 60), 30, barcode))
    return sorted(rows, key=lambda r: r[3])


def write_parts(spark, rows, folder, parts):
    """Files that a stream reads one by one, in order of their names."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        path = f"{folder}/part{k}"
        spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_000_000 + k, 1_000_000 + k))


def read_stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def batch(spark, rows, **options):
    return sorted(map(tuple, mol.build_molecules(spark.createDataFrame(rows, SCHEMA), **options).select(*COLUMNS).collect()))


@pytest.fixture(scope="module", autouse=True)
def package_on_workers(spark):
    """Python workers of the state server start outside this folder."""
    environment = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment["PYTHONPATH"] = os.pathsep.join([p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p] + [root])


@pytest.mark.parametrize("library", ["dbs", "10x"])
def test_strict_stream_equals_batch(spark, tmp_path, library):
    rows = draw(500, 1) + [("z", 4, None, 10**9, 10**9, 0, None)]
    # Reads of one micro-batch come in any order, and some come a batch late.
    shuffled = rows[:-1]
    choose = random.Random(2)
    for k in range(0, 440, 11):
        shuffled[k], shuffled[k + 60] = shuffled[k + 60], shuffled[k]
    choose.shuffle(shuffled[:125])
    write_parts(spark, [*shuffled, rows[-1]], str(tmp_path / "in"), 4)
    stream = strict.stream_molecules(read_stream(spark, tmp_path / "in"), library, 400, 1, 0, "30000 seconds")
    query = strict.run_available(stream, str(tmp_path / "out"))
    assert query.exception() is None
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out/molecules")).select(*COLUMNS).collect()))
    assert got == batch(spark, rows, library_type=library, window=400, min_reads=1)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 0


def test_late_reads_are_counted(spark, tmp_path):
    rows = draw(120, 3, barcodes=2)
    late = [("late", 0, "x", 5, 50, 30, "b0"), ("late", 0, "y", 6, 51, 30, "b1")]
    on, end = ("z", 4, None, 100_000, 100_000, 0, None), ("z", 4, None, 10**9, 10**9, 0, None)
    # Spark drops what lies behind the watermark of the batch before last; until then nothing of it is folded.
    write_parts(spark, rows + [on] * 120 + late * 60 + [end] * 120, str(tmp_path / "in"), 4)
    stream = strict.stream_molecules(read_stream(spark, tmp_path / "in"), "dbs", 400, 1, 0, "10 seconds")
    query = strict.run_available(stream, str(tmp_path / "out"))
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == len(late) * 60
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out/molecules")).select(*COLUMNS).collect()))
    assert got == batch(spark, rows, library_type="dbs", window=400, min_reads=1)


def test_places_along_a_genome(spark):
    offsets = spark.createDataFrame([("x", 0), ("y", 1000)], "rname string, offset long")
    reads = spark.createDataFrame([("x", 5), ("y", 7), (None, 9)], "rname string, start long")
    assert sorted(map(tuple, strict.genome_place(offsets, reads).collect()), key=str) == [("x", 5, 5), ("y", 7, 1007), (None, 9, None)]


def test_molecules_closed_by_the_walk_that_opened_them_are_not_stored():
    from types import SimpleNamespace
    from unittest.mock import MagicMock

    from tagweave.streaming.strict import StrictMolecules

    def fold(passed):
        walk, handle = StrictMolecules(10, (8, 10)), MagicMock()
        walk.init(handle)
        walk._pending, walk._open, walk._names = MagicMock(), MagicMock(), MagicMock()
        walk._pending.get.return_value = [(100, 120, "b", 100), (0, 5, "a", 0), (7, 20, "a", 7)]
        walk._open.exists.return_value = False
        timer = SimpleNamespace(getCurrentWatermarkInMs=lambda: passed * 1000)
        return walk, [r for frame in walk.handleExpiredTimer(("c", "x"), timer, None) for r in frame.itertuples(index=False, name=None)]

    walk, rows = fold(1000)
    assert rows == [("c", "x", 0, 20, 2, 20, 18), ("c", "x", 100, 120, 1, 20, 20)]
    assert not walk._open.update.called and not walk._names.updateValue.called and not walk._names.clear.called
    walk, rows = fold(110)
    assert rows == [("c", "x", 0, 20, 2, 20, 18)]
    walk._open.update.assert_called_once_with((100, 120, 1, 20, 100))
    walk._names.updateValue.assert_called_once_with(("b",), (True,))
