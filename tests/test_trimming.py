"""Approximate matching against the distance table, cell by cell."""

import random

import numpy as np
import pytest

from tagweave.functions.dna import IUPAC
from tagweave.operators import trimming as trim


def plain(read, pattern, rate, min_overlap):
    """(edits, begin, end, size) by dynamic programming: fewest edits, leftmost end, rightmost beginning; then cut-off beginnings."""
    m, columns = len(pattern), []
    column = [(i, 0) for i in range(m + 1)]
    columns.append(column)
    for j, base in enumerate(read, 1):
        new = [(0, -j)]
        for i in range(1, m + 1):
            same = base.upper() in IUPAC[pattern[i - 1]]
            new.append(min((column[i - 1][0] + (not same), column[i - 1][1]), (column[i][0] + 1, column[i][1]), (new[i - 1][0] + 1, new[i - 1][1])))
        column = new
        columns.append(column)
    allowed = lambda size: int(size * rate + 1e-9)
    edits, end = min(((c[m][0], j) for j, c in enumerate(columns[1:], 1)), default=(m + 1, 0))
    if edits <= allowed(m):
        return edits, -columns[end][m][1], end, m
    for size in range(m - 1, (min_overlap or m) - 1, -1):
        if read and columns[-1][size][0] <= allowed(size):
            return columns[-1][size][0], -columns[-1][size][1], len(read), size
    return -1, 0, 0, 0


def mutate(choose, letters, edits):
    out = list(letters)
    for _ in range(edits):
        at = choose.randrange(len(out)) if out else 0
        kind = choose.choice("SID")
        if kind == "I" or not out:
            out.insert(at, choose.choice("ACGT"))
        elif kind == "D":
            del out[at]
        else:
            out[at] = choose.choice("ACGTN")
    return "".join(out)


@pytest.mark.parametrize("letters,rate,min_overlap", [("CTGTCTCTTATACACATCT", 0.2, 3), ("ACGN", 0.25, 1), ("BDHVBDHVAC", 0.3, None), ("A" * 30 + "C" * 34, 0.1, 5), ("G", 0.0, None)])
def test_matches(letters, rate, min_overlap):
    choose = random.Random(len(letters))
    reads = ["", "A", "acgt"]
    for _ in range(150):
        head = "".join(choose.choice("ACGT") for _ in range(choose.randint(0, 30)))
        concrete = "".join(choose.choice(IUPAC[c]) for c in letters)
        planted = mutate(choose, concrete, choose.randint(0, 6))
        reads.append((head + planted)[: choose.randint(1, 90)] + choose.choice(["", "", "ACCA", concrete]))
    adapter = trim.Adapter(letters, rate)
    sizes = np.array([len(r) for r in reads])
    octets = np.frombuffer("".join(reads).encode(), dtype=np.uint8)
    found = trim.match(octets, np.cumsum(sizes) - sizes, sizes, adapter, min_overlap)
    got = list(zip(found.edits.tolist(), found.begin.tolist(), found.end.tolist(), found.size.tolist(), strict=True))
    assert got == [plain(r, letters, rate, min_overlap) for r in reads]


def test_adapters_fit_a_word():
    with pytest.raises(ValueError):
        trim.Adapter("A" * 65)
    with pytest.raises(ValueError):
        trim.Adapter("")


def test_trim_end_and_empty_tables(spark):
    end = trim.END_ADAPTER
    rows = [("a", "ACGTACGT" + end + "GATT", "I" * 31), ("b", "ACGTACGTCTGT", "J" * 12), ("c", "ACGTACGA", "K" * 8), ("d", None, None), ("e", "", "")]
    frame = spark.createDataFrame(rows, "name string, sequence string, quality string")
    got = {r.name: (r.sequence, r.quality) for r in trim.trim_end(frame).collect()}
    assert got == {"a": ("ACGTACGT", "I" * 8), "b": ("ACGTACGT", "J" * 8), "c": ("ACGTACGA", "K" * 8), "d": (None, None), "e": ("", "")}
    assert trim.trim_end(frame.limit(0)).count() == 0


def test_pairs(spark):
    choose = random.Random(9)
    insert = "".join(choose.choice("ACGT") for _ in range(40))
    barcode = "".join(choose.choice("ACGT") for _ in range(20))
    handles = trim.LEFT_HANDLE, trim.RIGHT_HANDLE
    first = {
        "plain": handles[0] + barcode + handles[1] + insert,
        "shifted": "GAT" + mutate(choose, handles[0], 1) + barcode + handles[1] + insert + trim.END_ADAPTER,
        "far": "GATTACA" + handles[0] + barcode + handles[1] + insert,
        "unsure": handles[0] + barcode[:10] + "N" + barcode[11:] + handles[1] + insert,
        "short": handles[0] + barcode + handles[1] + insert[:20],
        "bare": insert + "ACGT" * 10,
        "long_barcode": handles[0] + barcode + "AC" + handles[1] + insert,
    }
    rows = [(k, s, "I" * len(s), insert + trim.END_ADAPTER, "J" * 59) for k, s in first.items()]
    frame = spark.createDataFrame(rows, "name string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    got = {r.name: (r.barcode, r.r1_seq, len(r.r1_qual), r.r2_seq) for r in trim.trim_pairs(frame).collect()}
    whole = (insert, 40, insert)
    assert got["plain"] == (barcode, *whole) and got["shifted"] == (barcode, *whole)
    assert got["unsure"] == (None, *whole) and got["far"][0] is None and got["far"][1] == first["far"]
    assert "short" not in got and got["bare"][:2] == (None, first["bare"])
    assert got["long_barcode"] == (None, *whole)
