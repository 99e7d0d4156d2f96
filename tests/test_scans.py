"""Two-level scans and order statistics against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.functions import histograms as hist
from tagweave.functions import orderstats, scans


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    rows = []
    for key, size in (("hot", 400), ("a", 9), ("b", 1)):
        for pos in sorted(rng.sample(range(5000), size)):
            rows.append((key, pos, rng.randrange(50)))
    return rows


def test_ordered_scan(spark, skewed):
    df = spark.createDataFrame(skewed, "key string, pos bigint, v int").repartition(3)
    got = scans.ordered_scan(
        df,
        ["key"],
        "pos",
        64,
        i=scans.row_index(),
        cs=scans.running_sum(F.col("v")),
        total=scans.total_sum(F.col("v")),
        top=scans.running_max(F.col("v")),
        prior=scans.prior_max(F.col("v")),
        before=scans.previous(F.col("v")),
        after=scans.following(F.col("v")),
    )
    got = {(r.key, r.pos): r for r in got.collect()}
    for key in ("hot", "a", "b"):
        values = [(p, v) for k, p, v in skewed if k == key]
        for n, (pos, v) in enumerate(values):
            row, seen = got[(key, pos)], [x for _, x in values[: n + 1]]
            assert row.i == n + 1 and row.cs == sum(seen) and row.top == max(seen)
            assert row.total == sum(x for _, x in values)
            assert row.prior == (max(seen[:-1]) if n else None)
            assert row.before == (values[n - 1][1] if n else None)
            assert row.after == (values[n + 1][1] if n + 1 < len(values) else None)


def test_dense_ids(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"))
    ids = [r.n for r in scans.dense_ids(df, ["k"], "n", buckets=16).collect()]
    assert sorted(ids) == list(range(1, 501))


def test_n50_example(spark):
    df = spark.createDataFrame([(i,) for i in range(2, 11)], "l bigint")
    assert orderstats.n50_inclusive(df, "l", width=4).first().n50 == 8


def test_quantiles_match_numpy(spark, skewed):
    df = spark.createDataFrame(skewed, "key string, pos bigint, v int")
    got = {r.key: r for r in orderstats.exact_quantiles(df, "pos", {"m": 0.5, "q": 0.99}, ["key"], width=32).collect()}
    for key, row in got.items():
        values = [p for k, p, _ in skewed if k == key]
        assert row.m == pytest.approx(np.quantile(values, 0.5)) and row.q == pytest.approx(np.quantile(values, 0.99))


def test_nx_curve_never_exceeded_is_zero(spark):
    df = spark.createDataFrame([(10,), (20,), (30,)], "s bigint")
    curve = {r.x: r.y for r in orderstats.nx_curve(df, "s", width=8).collect()}
    assert len(curve) == 101 and curve[0] == 30 and curve[49] == 30 and curve[50] == 20 and curve[100] == 0
    far = {r.x: r.y for r in orderstats.nx_curve(df, "s", total=F.lit(1000), width=8).collect()}
    assert far[4] == 20 and far[5] == 10 and far[6] == 0


def test_geometric_histogram_example(spark):
    lengths = [12281, 232181, 452610, 751711, 1232230]
    df = spark.createDataFrame([(v,) for v in lengths], "l bigint")
    got = {r.kbp: r.density for r in hist.geometric_length_histogram(df, "l").collect()}
    assert {k: v for k, v in got.items() if v} == {10: 0.004581, 230: 0.086602, 440: 0.168821, 720: 0.280383, 1180: 0.459614}
    assert got[20] == 0.0 and max(got) == 1180


def test_right_closed_edges(spark):
    df = spark.createDataFrame([(v,) for v in (1, 999, 1000, 1001, 45000, 45500)], "l bigint")
    got = {r.l: r.b for r in df.select("l", hist.right_closed_bin(F.col("l"), 1000).alias("b")).collect()}
    assert got == {1: 0, 999: 0, 1000: 0, 1001: 1000, 45000: 44000, 45500: 45000}


def test_percent_bins_are_exact(spark):
    rows = [(n, d) for d in (7, 50, 100, 333) for n in range(0, d + 2)]
    df = spark.createDataFrame(rows, "n bigint, d bigint")
    for r in df.select("n", "d", hist.ratio_percent_bin(F.col("n"), F.col("d")).alias("b")).collect():
        expected = None if r.n == 0 or r.n > r.d else -(-r.n * 100 // r.d) - 1
        assert r.b == expected, r


def test_even_maximum_is_left_out_on_request(spark):
    df = spark.createDataFrame([(1,), (3,), (4,)], "n bigint")
    assert sorted((r.Bin, r.Count) for r in hist.count_histogram(df, "n", 2, True).collect()) == [(0, 1), (2, 1)]
    assert sorted((r.Bin, r.Count) for r in hist.count_histogram(df, "n", 2).collect()) == [(0, 1), (2, 1), (4, 1)]


def test_lookup_is_one_behaviour_at_every_size(spark):
    from tagweave.functions import skew

    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None, "alone"]), rng.randrange(3), i) for i in range(400)]
    rows += [("absent", 1, 1000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, j int, v int").withColumn("tags", F.create_map(F.lit("x"), "v"))
    table = spark.createDataFrame([(k, j, f"{k}{j}") for k in ("hot", "a", "b", "c") for j in (0, 1)], "k string, j int, w string")
    known = {(r.k, r.j): r.w for r in table.collect()}
    expected = {(k, j, v, known.get((k, j))) for k, j, v in rows}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for bound in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
            got = skew.lookup(df, table, ["k", "j"])
            assert got.columns == ["k", "j", "v", "tags", "w"]
            assert {(r.k, r.j, r.v, r.w) for r in got.collect()} == expected and got.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
