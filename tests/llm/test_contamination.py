"""Benchmark windows in documents against a search of every place."""

import random
import re

import numpy as np
import pytest

from tagweave.llm import contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, items):
    own = words(text)
    hit, found = set(), set()
    for key, item in items:
        other = words(item)
        size = min(13, len(other))
        windows = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if other else set()
        for i in range(len(own) - size + 1):
            if size and tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(key))
    return len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["Ab", "b", "c", "dé", "e1", "f"]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".\n", " "]) for _ in range(n))
    items = [(i, make(rng.choice([0, 1, 3, 12, 13, 14, 40]))) for i in range(1, 12)] + [(20, None), (21, "..."), (30, "rare unseen words")]
    items += [(40, items[-5][1]), (11, "another text with the id of a former one")]
    items = [(k, t) for k, t in items if len(words(t)) not in (1, 3)]
    docs = [make(rng.choice([0, 5, 30, 700])) for _ in range(30)] + [None, "", "rare, UNSEEN-words"]
    for i in range(12):
        pick = rng.choice(items)[1] or ""
        docs.append(make(50) + " " + pick.upper() + " " + make(30) + " " + pick)
    docs.append(" ".join([make(1200), items[3][1] or "", make(1500)]))
    return items, docs


@pytest.mark.parametrize("part_bytes", [10**9, 300])
def test_against_every_place(spark, part_bytes):
    items, docs = sample(part_bytes)
    table = spark.createDataFrame(list(enumerate(docs)) + [(0, docs[0])], "doc_id long, text string").selectExpr("*", "'own' as hits")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = contamination.contaminated(table, bench, part_bytes=part_bytes).collect()
    assert len(got) == len(docs) + 1
    for r in got:
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == expected(r.text, items)


def test_long_patterns_skip(spark):
    items = [("a", " ".join(f"w{i}" for i in range(60)))]
    searchers = contamination.build_searchers(["a"], [items[0][1].encode()])
    assert [s.length for s in searchers] == [13]
    assert np.median(searchers[0].shift) == 12
    docs = spark.createDataFrame([(1, "x y z " * 200 + items[0][1] + " end" * 40)], "doc_id long, text string")
    row = contamination.contaminated(docs, spark.createDataFrame(items, "item_id string, text string")).first()
    assert [tuple(h) for h in row.hits] == [(600, 660)] and row.item_ids == ["a"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert contamination.contaminated(docs, none).first().n_hit == 0
    assert contamination.contaminated(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("part_bytes", [10**9, 30])
def test_null_item_ids(spark, part_bytes):
    passages = [f"passage {k} " + " ".join(f"w{k}x{i}" for i in range(14)) for k in range(3)]
    bench = spark.createDataFrame([(None, passages[0]), (None, passages[1]), (7, passages[2])], "item_id long, text string")
    texts = [passages[0], f"{passages[1]} and {passages[0]}", f"{passages[2]} {passages[0]}", "nothing of them"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids, r.contaminated) for r in contamination.contaminated(docs, bench, part_bytes=part_bytes).collect()}
    assert got == {0: (16, [None], True), 1: (32, [None], True), 2: (32, ["7", None], True), 3: (0, [], False)}


def test_sql_counts_null_item_ids(spark, tmp_path):
    import duckdb

    from tagweave.llm.queries import CATALOG

    name = "op7_benchmark_decontamination"
    bench = [(None, "some words that nobody else has"), (None, "and other words too"), (3, "a third item")]
    texts = ["here are some words that nobody else has", "and other words too, a third item", None, "some words"]
    for table, rows, schema in (("documents", list(enumerate(texts)), "doc_id long, text string"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    relation = connection.execute(CATALOG.sql[name])
    columns = [d[0] for d in relation.description]
    assert sorted(map(tuple, CATALOG.queries[name](spark, str(tmp_path)).select(*columns).collect())) == sorted(relation.fetchall())
