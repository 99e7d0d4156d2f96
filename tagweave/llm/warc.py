"""Content-addressed WARC archive: payload bytes once by digest, exact record headers apart, records put together again by joins.

``write_archive`` stores two tables in a folder that all executors share:

* ``payloads``: one row per SHA-256 digest with the payload's bytes;
* ``headers``: one row per record with its exact bytes up to the payload (WARC header, blank line, HTTP header, blank line) and the digest.

The first record of a payload (by key) is its ``response``; later ones are ``revisit`` records that name it, unless the payload is
shorter than ``MIN_REVISIT`` bytes. ``read_archive`` joins the tables; every payload is hashed again, once, where it is stored, and a digest that
does not fit fails the job. A payload is only moved for readers that select it: records without their bytes cost a join of digests.

``write_files`` writes the records as ``.warc.gz`` files and ``read_files`` reads such files, of this or another origin, streaming: a file
is cut where a record seems to begin, and ``Content-Length`` decides whether it does, so payloads may hold whole records.

Defined cases: a null payload is empty; null addresses and keys leave their header fields out, and a null key is null again when read; keys and
addresses with control characters are percent-encoded in headers (keys are decoded when read); null keys come last; of rows with equal key and
payload one is the response and the others revisit it; repeated rows are records of their own; very long payloads are one
value each (up to Spark's 2 GB); other columns, whatever their names, are not archived; empty tables give empty archives.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.session import checkpointed, shared_folder

MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"
_KEY, _REFERS = "WARC-Source-Key", "WARC-Refers-To-Source-Key"


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit(""))


def _safe(value: Column) -> Column:
    """Text without control characters or blanks at its ends, percent-encoded so that it can be told again."""
    text = F.replace(value.cast("string"), F.lit("%"), F.lit("%25"))
    for code in (*range(0x21), 0x7F):
        text = F.replace(text, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(value.cast("string").rlike("[%\\x00-\\x20\\x7F]"), text).otherwise(value.cast("string"))


def _plain(text: Column) -> Column:
    """The inverse of ``_safe``."""
    for code in (0x7F, *range(0x21)):
        text = F.replace(text, F.lit(f"%{code:02X}"), F.lit(chr(code)))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def _urn(record: Column, digest: Column) -> Column:
    name = F.sha2(F.concat(record.cast("string"), F.lit(":"), digest), 256)
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE) -> DataFrame:
    """(record, digest, head): the exact header bytes of one WARC record per page, written once so that record numbers hold."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    drawn = checkpointed(
        pages.select(
            F.monotonically_increasing_id().alias("record"),
            F.col(key).alias("key"),
            F.col(url).cast("string").alias("url"),
            F.sha2(body, 256).alias("digest"),
            F.octet_length(body).cast("long").alias("size"),
        )
    )
    # Each task forms its own minima first, so a payload of very many pages is a few rows here.
    place = F.struct(F.col("key").isNull().alias("unnamed"), "key", "record")
    firsts = drawn.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min(place).alias("first"))
    told = lookup(drawn, firsts, "digest")
    again = F.col("first").isNotNull() & (F.col("first.record") != F.col("record"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("size").cast("string"), F.lit(_END * 2)
    )
    length = F.octet_length("http") + F.when(again, 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _urn(F.col("record"), F.col("digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _safe(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Profile", F.when(again, PROFILE)),
        _field("WARC-Refers-To", F.when(again, _urn(F.col("first.record"), F.col("digest")))),
        _field(_KEY, _safe(F.col("key"))),
        _field(_REFERS, F.when(again, _safe(F.col("first.key")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length.cast("string")),
        F.lit(_END),
        F.col("http"),
    )
    return told.withColumn("http", http).select("record", "digest", head.alias("head"))


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE) -> None:
    """Store the records of ``pages`` under ``folder``, which must not hold an archive."""
    records(pages, key, url, payload, date).write.parquet(f"{folder}/headers")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    # One value for each digest leaves every task, so copies are not shuffled.
    stored = pages.select(F.sha2(body, 256).alias("digest"), body.alias("payload")).groupBy("digest").agg(F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def _header(name: str) -> Column:
    """The value of a header field, null where it is missing."""
    found = F.regexp_extract("head", rf"\r\n{re.escape(name)}: ([^\r]*)\r\n", 1)
    return F.when(F.col("head").contains(f"{_END}{name}: "), found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``record, record_type, key, refers_to, url, payload_digest, payload_bytes, head, payload``.

    ``payload`` is the full payload of revisits, too. ``key`` and ``refers_to`` are strings, as headers hold them.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    same = F.sha2("payload", 256) == F.col("digest")
    wrong = F.raise_error(F.concat(F.lit("payload does not have its digest: "), F.col("digest")))
    checked = payloads.select(
        F.col("digest").alias("_digest"),
        F.when(same, F.col("digest")).otherwise(wrong).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload",
    )
    # Both sides are plain, so the records of a very common payload are split at run time.
    joined = spark.read.parquet(f"{folder}/headers").join(checked, F.col("digest") == F.col("_digest"), "left")
    return joined.select(
        "record",
        _header("WARC-Type").alias("record_type"),
        _plain(_header(_KEY)).alias("key"),
        _plain(_header(_REFERS)).alias("refers_to"),
        _header("WARC-Target-URI").alias("url"),
        "payload_digest",
        "payload_bytes",
        "head",
        "payload",
    )


def record_bytes() -> Column:
    """The record as a WARC file holds it, without the blank lines that follow: a revisit ends with its HTTP header."""
    own = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("head").cast("binary"), own)


def write_files(archive: DataFrame, folder: str) -> None:
    """Write records as ``.warc.gz`` files. A record of text ends where the next begins, as lines of a text file do."""
    lines = archive.select(record_bytes().cast("string").alias("value"))
    lines.write.option("lineSep", _END * 2).option("compression", "gzip").text(folder)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(head, block) of every record of WARC files: the header's bytes with its blank line, and ``Content-Length`` bytes.

    Compressed files are read by one task each, streaming; a record that a file ends within fails the job.
    """
    # A split inside a file could fall into a payload that holds a record; compressed files are never split.
    parts = spark.read.option("lineSep", f"{_END * 2}WARC/").text(path)
    parts = parts.select(F.col("value").cast("binary").alias("part"), F.input_file_name().alias("file"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, need = None, b"", 0
        heads, blocks, size = [], [], 0
        for batch in batches:
            for part, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                octets = part.as_buffer().to_pybytes()
                if own != file:
                    if held:
                        raise ValueError(f"{file} ends within a record")
                    file = own
                    octets = octets.removeprefix(b"WARC/")
                held = held + b"\r\n\r\nWARC/" + octets if held else b"WARC/" + octets
                # Parts of a payload are only joined on; the header is read once.
                if not need:
                    at = held.find(b"\r\n\r\n") + 4
                    found = re.search(rb"\r\ncontent-length: *([0-9]+)", held[:at], re.IGNORECASE)
                    if at < 4 or not found:
                        raise ValueError(f"{file} holds a record without Content-Length")
                    need = at + int(found[1])
                if len(held) >= need:
                    heads.append(held[:at])
                    blocks.append(held[at:need])
                    size += len(held)
                    held, need = b"", 0
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(blocks, pa.binary())], names=["head", "block"])
                    heads, blocks, size = [], [], 0
        if held:
            raise ValueError(f"{file} ends within a record")
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(blocks, pa.binary())], names=["head", "block"])

    return parts.mapInArrow(join, "head binary, block binary")


def new_folder(spark: SparkSession) -> str:
    """A folder for one archive among the shared files of the session."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4()}"
