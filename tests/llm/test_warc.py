"""WARC archives: exact round trips, revisits by a plain loop, odd values, damaged files."""

import gzip
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tagweave.llm import warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>caf\xe9 " * 40
ROWS = [
    (3, "http://a/3", LONG),
    (1, "http://a/1", LONG),
    (2, "http://a/2\r\nX: y", LONG + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello"),
    (4, None, "short"),
    (5, "http://a/5", "short"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (None, "http://a/n", LONG),
    (8, "http://a/8", "x" * 100),
    (9, "http://a/9", "x" * 100),
    (9, "http://a/9", "x" * 100),
    (10, "http://a/10", "y" * 99),
    (11, "http://a/11", "y" * 99),
    (None, "http://a/m", "z" * 200),
]


def plain(rows):
    out = []
    seen = set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        octets = (html or "").encode()
        first = min((r[0] for r in rows if (r[2] or "").encode() == octets and r[0] is not None), default=None)
        again = len(octets) >= 100 and octets in seen
        seen.add(octets)
        out.append((page, len(octets), hashlib.sha256(octets).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "archive")
    frame = spark.createDataFrame(ROWS, SCHEMA).withColumns({"record": F.lit("x"), "digest": F.lit(1), "payload": F.lit(2)})
    warc.write_archive(frame.repartition(3), folder)
    return folder


def test_types_and_digests(spark, archive):
    rows = warc.read_archive(spark, archive).collect()
    got = [(None if r.key is None else int(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in rows]
    assert sorted(got, key=str) == plain(ROWS)
    assert sorted(bytes(r.payload).decode() for r in rows) == sorted(r[2] or "" for r in ROWS)


def test_payloads_are_stored_once(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == len({r[2] or "" for r in ROWS})
    assert "payload" not in spark.read.parquet(f"{archive}/headers").columns


def test_headers_are_well_formed(spark, archive):
    ids, referred = set(), set()
    for row in warc.read_archive(spark, archive).collect():
        header, http, rest = row.head.split("\r\n\r\n")
        assert rest == "" and header.startswith("WARC/1.1\r\nWARC-Type: ")
        fields = dict(line.split(": ", 1) for line in header.split("\r\n")[1:])
        own = len(row.payload) if row.record_type == "response" else 0
        assert int(fields["Content-Length"]) == len((http + "\r\n\r\n").encode()) + own
        ids.add(fields["WARC-Record-ID"])
        if row.record_type == "revisit":
            referred.add(fields["WARC-Refers-To"])
    assert len(ids) == len(ROWS) and referred < ids


def test_files_round_trip(spark, archive, tmp_path):
    held = warc.read_archive(spark, archive)
    expected = sorted(bytes(r[0]) for r in held.select(warc.record_bytes()).collect())
    warc.write_files(held.coalesce(2), str(tmp_path / "files"))
    again = warc.read_files(spark, str(tmp_path / "files")).collect()
    assert sorted(bytes(r.head) + bytes(r.block) for r in again) == expected
    # Any reader finds the records: walk one file by Content-Length.
    whole = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "files").glob("*.gz")))
    found = []
    while whole:
        head, _, rest = whole.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        found.append(head + b"\r\n\r\n" + rest[:size])
        assert rest[size : size + 4] == b"\r\n\r\n"
        whole = rest[size + 4 :]
    assert sorted(found) == expected


def test_foreign_files(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\ncontent-length: 3\r\n\r\n\xff\x00\n\r\n\r\n"
    other = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    with open(tmp_path / "a.warc.gz", "wb") as out:
        out.write(gzip.compress(record) + gzip.compress(other) + gzip.compress(record))
    rows = warc.read_files(spark, str(tmp_path / "a.warc.gz")).collect()
    assert [bytes(r.block) for r in rows] == [b"\xff\x00\n", b"", b"\xff\x00\n"]
    with open(tmp_path / "b.warc.gz", "wb") as out:
        out.write(gzip.compress(record[:-6]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_files(spark, str(tmp_path / "b.warc.gz")).collect()


def test_damage_is_found(spark, archive, tmp_path):
    damaged = str(tmp_path / "damaged")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{damaged}/headers")
    bad = F.when(F.octet_length("payload") > 50, F.concat("payload", F.lit(b"!"))).otherwise(F.col("payload"))
    spark.read.parquet(f"{archive}/payloads").withColumn("payload", bad).write.parquet(f"{damaged}/payloads")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, damaged).collect()


def test_text_keys_and_empty_tables(spark, tmp_path):
    rows = [("a%20b\r\nWARC-Type: x", "u", LONG), ("z \x7f", "u", LONG), ("", "u", "")]
    frame = spark.createDataFrame(rows, "name string, url string, body string")
    warc.write_archive(frame, str(tmp_path / "a"), key="name", payload="body")
    got = warc.read_archive(spark, str(tmp_path / "a")).select("key", "refers_to").collect()
    assert sorted(map(tuple, got)) == sorted([(rows[0][0], None), (rows[1][0], rows[0][0]), ("", None)])
    warc.write_archive(frame.limit(0), str(tmp_path / "b"), key="name", payload="body")
    assert warc.read_archive(spark, str(tmp_path / "b")).count() == 0


def test_long_payload(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u")], "page_id long, url string").withColumn("html", F.repeat(F.lit("0123456789"), 600_000))
    warc.write_archive(frame, str(tmp_path / "a"))
    row = warc.read_archive(spark, str(tmp_path / "a")).select("payload_bytes", "payload_digest").first()
    assert tuple(row) == (6_000_000, hashlib.sha256(b"0123456789" * 600_000).hexdigest())
