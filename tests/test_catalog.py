"""Every registered query against its SQL on the smallest data set."""

import decimal
import glob
import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from tagweave.catalog import load_catalog

SF_DIR = "/root/testdata/sf0.001"
CATALOG = load_catalog()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


def canonical(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return "None" if math.isnan(float(value)) else repr(round(float(value), 6))
    return str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(CATALOG.queries) == set(CATALOG.sql)
    assert set(CATALOG.queries) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(CATALOG.queries))
def test_query_matches_sql(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = sorted(tuple(canonical(row[c]) for c in columns) for row in frame.collect())
    relation = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(tuple(canonical(row[i]) for i in places) for row in relation.fetchall())
    assert got == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
