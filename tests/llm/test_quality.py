"""Quality scores: held-out accuracy, neighbours, odd texts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import language, quality

SF_DIR = "/root/testdata/sf0.01"
GOOD = "The river runs past the old mill, and nobody minds.\nIn winter it freezes; in spring it floods the meadow.\nThat is all."
BAD = "HOME | NEWS | ABOUT\n$$$ win$$$ now$$$ !!!\nclick click click click"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels.where(~language.held_out()))
    got = quality.classify(docs, model).where(language.held_out()).join(labels, "doc_id").toPandas()
    assert len(got) > 80 and (got.quality == got.predicted).mean() >= 0.95
    assert got.score.between(0, 1).all()


def lines_of(*texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)


def test_lines():
    lines = quality.read_lines(*lines_of("a b c\n\n \na b c\n", "", "Ä! Ä!\nx"))
    assert lines.row.tolist() == [0, 0, 2, 2] and lines.words.tolist() == [3, 3, 2, 1]
    assert lines.numbers[:, -1].tolist() == [1, 1, 0, 0]
    bins = quality._bins(np.zeros((lines.numbers.shape[1], 2)), lines)
    assert (bins[1, [0, 2]] == 3).all() and (bins[2, [1, 3]] == 3).all()
    assert (bins[1, 1] == bins[0, 0]).all() and (bins[2, 0] == bins[0, 1]).all()


def test_odd_rows(spark):
    rows = [(i, GOOD + f"\nLine {i} ends here, as it should.") for i in range(12)] + [(100 + i, BAD + f" {i}") for i in range(6)]
    labels = [(i, 1, 0) for i in range(12)] + [(100 + i, 0, 0) for i in range(6)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)]
    odd = [(200, None), (201, ""), (202, " \n\t"), (None, GOOD), (203, BAD * 3000), (203, BAD * 3000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").withColumn("score", F.lit("own"))
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = quality.classify(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: (r.score, r.predicted) for r in got}
    assert all(by_id[i][1] == 1 for i in range(12)) and all(by_id[100 + i][1] == 0 for i in range(6))
    assert by_id[200] == by_id[201] == by_id[202] == (model.prior, 1)
    assert by_id[None][1] == 1 and by_id[203][1] == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, GOOD), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, none)
    assert [r.score for r in quality.classify(docs, model).collect()] == [0.5, 0.5]
    only = quality.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert all(r.predicted == 1 for r in quality.classify(docs, only).collect())
    assert quality.classify(docs.limit(0), model).count() == 0
