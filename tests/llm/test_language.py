"""Language identification: held-out accuracy, code-switched words, odd texts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import language

SF_DIR = "/root/testdata/sf0.001"
EN = "the house of the king was by the river and it is old that is why they went there with their horses in the morning"
DE = "das haus des königs war am fluss und es ist alt darum gingen sie dort mit ihren pferden am morgen und nicht am abend"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.train(docs.where(~language.held_out()))
    got = language.identify(docs, model).where(language.held_out()).toPandas()
    assert len(got) > 40 and (got.lang == got.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_words_of_switched_text():
    texts, names = [EN, DE] * 6, ["en", "de"] * 6
    model = language.fit(texts, names)
    halves = [" ".join(t.split()[:11]) for t in (EN, DE)]
    data = " ".join(halves).encode()
    words, chances = language.word_chances(model, np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    best = [model.languages[k] for k in chances.argmax(axis=1)]
    assert best[:10] == ["en"] * 10 and best[12:] == ["de"] * 10
    assert len(words.row) == 22 and np.allclose(chances.sum(axis=1), 1)
    assert model.chain.transitions[0, 0] > model.chain.transitions[0, 1]


def test_odd_rows(spark):
    rows = [(1, EN, "en"), (2, DE, "de"), (3, None, "en"), (4, "", None), (5, "12 + 3 !?", "en"), (6, "😀 ²", "de"), (None, DE, "de"), (1, EN, "en")]
    rows += [(7, EN.upper() + " " + EN * 500, None), (8, "привет мир", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    model = language.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert got[1][0] == got[7][0] == "en" and got[2][0] == got[None][0] == "de"
    assert all(got[k] == ("und", 1.0) for k in (3, 4, 5, 6))
    assert got[8][0] in ("en", "de")
    assert language.identify(docs, model).count() == len(rows)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model is None
    assert [tuple(r)[-2:] for r in language.identify(docs, model).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0), model).count() == 0


def test_sample_keeps_rare_languages(spark):
    sizes = {f"l{k:02}": 3000 for k in range(8)} | {"r1": 60, "r2": 41, "r3": 5, "r4": 1}
    rows = [(i, f"word{i} {name}", name) for i, name in enumerate(n for n, size in sizes.items() for _ in range(size))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = [name for _, name in language.training_rows(docs, "text", "lang", "doc_id", rows=480)]
    assert {n: drawn.count(n) for n in sizes} == {n: min(40, size) for n, size in sizes.items()}
    repeated = docs.where("lang = 'r1'").crossJoin(spark.range(20)).unionByName(docs.selectExpr("*", "0L as id"))
    assert len(language.training_rows(repeated, "text", "lang", "doc_id", rows=480)) <= 480


def test_more_than_a_hundred_languages(spark):
    names = [f"l{k:03}" for k in range(101)]
    rows = [(101 * i + k, " ".join(f"{chr(97 + k // 26)}{chr(97 + k % 26)}{w}" for w in ("ona", "ulti", "erre")), n) for i in range(2) for k, n in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = language.training_rows(docs, "text", "lang", "doc_id")
    assert sorted(drawn) == sorted((t, n) for _, t, n in rows)
    assert len(language.training_rows(docs, "text", "lang", "doc_id", rows=101)) == 101
    model = language.fit([t for t, _ in drawn], [n for _, n in drawn], rounds=12)
    assert model.languages == names
    got = language.identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(rows)
