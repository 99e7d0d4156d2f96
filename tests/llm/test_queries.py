"""Registered queries against their SQL; every query's columns, rows and repeatability."""

import glob
import os

import duckdb
import pytest

from tagweave.llm.queries import CATALOG

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")

COLUMNS = {
    "op1_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op4_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op6_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_benchmark_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op8_license_scan": ["doc_id", "n_licenses", "licenses", "best_dice"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op12_tokenizer_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_warc_archive": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op11_phrase_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}
# The table of which a query returns one row each; others return what SQL or their own tests say.
ROWS_OF = {"op11_phrase_collocations": None, "op13_warc_archive": ("pages", "page_id")}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def shown(value):
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def test_every_operator_is_registered():
    assert sorted(CATALOG.queries) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_and_columns(spark, duck, name):
    frame = CATALOG.queries[name](spark, SF_DIR)
    assert frame.columns == COLUMNS[name]
    rows = frame.collect()
    source = ROWS_OF.get(name, ("documents", "doc_id"))
    if source:
        known = duck.execute(f"SELECT {source[1]} FROM {source[0]} ORDER BY 1").fetchall()
        assert sorted(r[source[1]] for r in rows) == [r[0] for r in known]
    if name in CATALOG.sql:
        relation = duck.execute(CATALOG.sql[name])
        names = [d[0] for d in relation.description]
        places = [names.index(c) for c in COLUMNS[name]]
        expected = sorted(tuple(shown(row[i]) for i in places) for row in relation.fetchall())
        assert sorted(tuple(shown(v) for v in r) for r in rows) == expected
    else:
        again = CATALOG.queries[name](spark, SF_DIR).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))
