"""Alignment of tokenizers against plain loops over the libraries' own tokens."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import alignment

FIRST, SECOND = f"{alignment.FOLDER}/{alignment.BYTE_BPE}", f"{alignment.FOLDER}/{alignment.PIECE_BPE}"
pytestmark = pytest.mark.skipif(not os.path.exists(FIRST), reason="needs the tokenizers")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def token_octets(libraries):
    first, second = libraries
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    of_a = lambda k: bytes(back[c] for c in first.id_to_token(k))
    of_b = lambda k: bytes([int(second.id_to_piece(k)[3:5], 16)]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode()
    return of_a, of_b


def plain(texts, libraries):
    first, second = libraries
    of_a, of_b = token_octets(libraries)
    held, links, counts = [], [], Counter()
    for text in texts:
        a = b = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            whole = (" " + text).encode()
            if b"".join(map(of_a, a)) != whole or b"".join(map(of_b, b)) != whole:
                a = b = []
        ends_a, ends_b = np.cumsum([len(of_a(x)) for x in a]).tolist(), np.cumsum([len(of_b(x)) for x in b]).tolist()
        own = []
        for i, end in enumerate(ends_a):
            begin = ends_a[i - 1] if i else 0
            for j, other in enumerate(ends_b):
                if max(begin, ends_b[j - 1] if j else 0) < min(end, other):
                    own.append((a[i], b[j]))
        common = sorted(set(ends_a) & set(ends_b))
        parts, i, j = [], 0, 0
        for end in common:
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            parts.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        held.append((len(a), len(b), len(common), len(own), ";".join(parts)))
        links.append(own)
        counts.update(set(own))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return [
        (*h[:4], sum(counts[p] == highest[p[0]] for p in own), sum(counts[p] for p in own), h[4]) for h, own in zip(held, links, strict=True)
    ]


TEXTS = [
    None,
    "",
    "a",
    " ",
    "Hello world, this is a test of tokenization.",
    "Hello world, this is a test of tokenization.",
    "  leading  and   trailing  ",
    "tabs\tand\nlines\r\n\n",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁marked",
    "\xdcberstra\xdfe, \xe9l\xe8ve, \xf1and\xfa — “quoted”",
    "日本語の文章 \U0001d4b3 \U0001f600 абв",
    "x" * 300,
    "\x00\x01 nul",
]


def test_against_plain(spark, libraries, monkeypatch):
    choose = random.Random(2)
    words = ["the", "Tokenization", "un", "\xe9t\xe9", "12345", "foo_bar", "...", "\n", "antidisestablishment"]
    texts = TEXTS + [" ".join(choose.choices(words, k=choose.randint(1, 40))) for _ in range(60)]
    expected = plain(texts, libraries)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"n_a": F.lit(1), "groups": F.lit("x")})
    for size, work in ((10**6, 1024), (200, 7)):
        monkeypatch.setattr(alignment, "SLICE_BYTES", size)
        monkeypatch.setattr(alignment, "WORK", work)
        rows = alignment.align(frame.repartition(3)).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in rows] == expected
        assert [r.doc_id for r in rows] == list(range(len(texts)))


def test_repeated_rows_null_ids_and_empty_tables(spark, libraries):
    rows = [(None, "same text"), (1, "same text"), (1, "same text"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r[1:] for r in alignment.align(frame).collect()), key=str)
    assert got == sorted(plain([t for _, t in rows], libraries), key=str)
    assert alignment.align(frame.limit(0)).collect() == []
    named = frame.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body"))
    assert alignment.align(named, key="name", text="body").where("name = '1'").count() == 2


def test_long_text_is_whole(spark, libraries):
    text = "Some words of a long text, again. " * 60_000
    row = alignment.align(spark.createDataFrame([(7, text)], "doc_id long, text string")).first()
    first, second = libraries
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    assert (row.n_a, row.n_b) == (len(a), len(b)) and row.n_links == row.n_a + row.n_b - row.n_groups
    assert row.n_links == row.count_sum == row.n_best
    parts = [p.split("|") for p in row.groups.split(";")]
    assert [int(x) for p in parts for x in p[0].split(",")] == a and [int(x) for p in parts for x in p[1].split(",")] == b


def test_merge_in_pieces():
    choose = np.random.Generator(np.random.Philox(1))
    for n, m, work in ((1, 1, 1), (50, 3, 4), (3, 50, 9), (400, 380, 32), (40, 40, 1000)):
        end = 5 * (n + m)
        a = np.append(np.sort(choose.choice(end - 1, n - 1, replace=False) + 1), end) if n > 1 else np.array([end])
        b = np.append(np.sort(choose.choice(end - 1, m - 1, replace=False) + 1), end) if m > 1 else np.array([end])
        at_a, at_b, group, n_groups = alignment.merge_pieces(a, b, work)
        union = np.union1d(a, b)
        assert at_a.tolist() == np.searchsorted(a, union).tolist() and at_b.tolist() == np.searchsorted(b, union).tolist()
        common = np.intersect1d(a, b)
        assert n_groups == len(common) and group.tolist() == np.searchsorted(common, union).tolist()
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for d in range(n + m + 1):
            assert alignment.merge_path(a, b, np.array([d]))[0] == sum(1 for _, side in merged[:d] if not side)


def test_engines_agree(libraries):
    """The faster library and the vocabulary's own one give the same tokens."""
    with open(FIRST, "rb") as first:
        tokens = alignment.ByteTokens(first.read())
    assert tokens._fast is not None
    choose = random.Random(4)
    letters = [chr(c) for c in (*range(0, 0x250), *range(0x2010, 0x2028), 0x20AC)]
    texts = ["".join(choose.choices(letters + [" "] * 100 + list("etaoin") * 20, k=80)) for _ in range(400)]
    assert [tokens._fast.encode_ordinary(t) for t in texts] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
