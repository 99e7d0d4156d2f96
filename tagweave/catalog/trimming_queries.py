"""Queries on raw reads: adapters found in spite of errors, barcodes between handles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.views import table
from tagweave.operators import trimming as trim

CATALOG = Catalog()
LEFT, RIGHT = trim.LEFT_HANDLE, trim.RIGHT_HANDLE
# The adapter as reads show it: exact, a base replaced, one lost, one more, a few replaced.
SHOWN = [
    trim.END_ADAPTER,
    trim.END_ADAPTER[:5] + "G" + trim.END_ADAPTER[6:],
    trim.END_ADAPTER[:8] + trim.END_ADAPTER[9:],
    trim.END_ADAPTER[:10] + "G" + trim.END_ADAPTER[10:],
    "GG" + trim.END_ADAPTER[2:9] + "CC" + trim.END_ADAPTER[11:],
]
HANDLES = [LEFT, LEFT[:9] + LEFT[10:], LEFT[:20] + "TT" + LEFT[20:], LEFT[:3] + "A" + LEFT[4:]]


def _bases(length, turn):
    """Bases made up from arithmetic on the row."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1).cast("long"), length),
            lambda i: F.substring(F.lit("ACGT"), ((i * i * 3 + i * (turn % 11) + F.floor(turn * i / 7)) % 4 + 1).cast("int"), F.lit(1)),
        ),
        "",
    )


def _sql_bases(length: str, turn: str) -> str:
    return f"array_to_string(list_transform(range(1, {length} + 1), lambda i: substr('ACGT', CAST((i * i * 3 + i * ({turn} % 11) + {turn} * i // 7) % 4 AS INT) + 1, 1)), '')"


def order_reads(spark, sf_dir):
    """Orders as reads: an insert, then the adapter as shown, or its beginning, or nothing."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    shown = F.element_at(F.array(*map(F.lit, SHOWN)), (k % len(SHOWN) + 1).cast("int"))
    tail = F.when(c % 5 == 0, F.lit("")).when(c % 5 == 1, F.substring(shown, F.lit(1), (c % 17 + 1).cast("int"))).otherwise(F.concat(shown, F.lit("GATTACA")))
    rows = table(spark, sf_dir, "orders")
    return rows.select(k.alias("read"), F.concat(_bases(20 + k % 30, c), tail).alias("sequence"))


_SHOWN = "[" + ", ".join(f"'{s}'" for s in SHOWN) + f"][o_orderkey % {len(SHOWN)} + 1]"
ORDER_READS = f"""
reads AS (
  SELECT o_orderkey AS read, {_sql_bases("20 + o_orderkey % 30", "o_custkey")} ||
    CASE WHEN o_custkey % 5 = 0 THEN '' WHEN o_custkey % 5 = 1 THEN substr({_SHOWN}, 1, CAST(o_custkey % 17 + 1 AS INT)) ELSE {_SHOWN} || 'GATTACA' END AS sequence
  FROM orders)"""


def _table_of(name: str, source: str, pattern: str) -> str:
    """The distance table of ``pattern`` in the ``sequence`` of every row of ``source``, column by column.

    A cell holds 1000 times its edits plus 999 less where its match begins, so the least cell is the fewest edits from the rightmost beginning.
    """
    m = len(pattern)
    cells = [f"least(p{i - 1} + CASE WHEN substr(sequence, j + 1, 1) = '{c}' THEN 0 ELSE 1000 END, p{i} + 1000, d{i - 1} + 1000) AS d{i}" for i, c in enumerate(pattern, 1)]
    start = ", ".join(f"{1000 * i + 999} AS p{i}" for i in range(m + 1))
    return f"""{name} AS (
      SELECT read, sequence, 0 AS j, {start} FROM {source}
      UNION ALL
      SELECT read, sequence, j + 1, {", ".join(f"d{i}" for i in range(m + 1))} FROM (
        SELECT read, sequence, j, 999 - (j + 1) AS d0, {", ".join(cells)} FROM {name} WHERE j < length(sequence)))"""


def _whole(name: str, cells: str, pattern: str) -> str:
    m = len(pattern)
    return f"""{name} AS (
      SELECT read, CAST(best // 1000 AS INT) AS edits, CAST(999 - best % 1000 AS INT) AS begin_at, j AS end_at FROM (
        SELECT read, j, p{m} AS best, row_number() OVER (PARTITION BY read ORDER BY p{m} // 1000, j) AS place FROM {cells} WHERE j > 0)
      WHERE place = 1 AND best // 1000 <= {int(m * trim.ERROR_RATE + 1e-9)})"""


_END = trim.END_ADAPTER
_PARTIAL = " UNION ALL ".join(
    f"SELECT read, {size} AS size, p{size} AS best, j FROM cells WHERE j = length(sequence) AND p{size} // 1000 <= {int(size * trim.ERROR_RATE + 1e-9)}"
    for size in range(trim.MIN_OVERLAP, len(_END))
)


@CATALOG.query(
    "adapter_matches",
    f"""WITH RECURSIVE {ORDER_READS}, {_table_of("cells", "reads", _END)}, {_whole("whole", "cells", _END)},
    partial AS (SELECT read, max_by(best, size) AS best, max(size) AS size, any_value(j) AS j FROM ({_PARTIAL}) GROUP BY read)
    SELECT read, CAST(coalesce(w.edits, p.best // 1000, -1) AS INT) AS adapter_edits,
           CAST(coalesce(w.begin_at, 999 - p.best % 1000, 0) AS INT) AS adapter_begin,
           CAST(coalesce(w.end_at, p.j, 0) AS INT) AS adapter_end,
           CASE WHEN w.read IS NOT NULL THEN {len(_END)} ELSE coalesce(p.size, 0) END AS adapter_size,
           CASE WHEN w.read IS NULL AND p.read IS NULL THEN sequence ELSE substr(sequence, 1, coalesce(w.begin_at, 999 - p.best % 1000)) END AS kept
    FROM reads LEFT JOIN whole w USING (read) LEFT JOIN partial p USING (read)""",
)
def adapter_matches(spark, sf_dir):
    """Where the end adapter begins in every read, in spite of errors, and what is left of the read."""
    found = trim.find_adapter(order_reads(spark, sf_dir), _END)
    cut = F.when(F.col("adapter_edits") < 0, F.col("sequence")).otherwise(F.expr("substring(sequence, 1, adapter_begin)"))
    return found.select("read", "adapter_edits", "adapter_begin", "adapter_end", "adapter_size", cut.alias("kept"))


def part_reads(spark, sf_dir):
    """Parts as reads: a few bases, the left handle as shown, a barcode, the right handle, an insert."""
    k = F.col("p_partkey")
    left = F.element_at(F.array(*map(F.lit, HANDLES)), (k % len(HANDLES) + 1).cast("int"))
    front = F.substring(F.lit("GATTACA"), F.lit(1), (k % 6).cast("int"))
    barcode = F.when(k % 19 == 0, F.lit("ACGTNACGTACGTACGTACG")).otherwise(_bases(18 + k % 5, k))
    right = F.when(k % 23 == 0, F.lit("")).when(k % 3 == 0, F.lit(RIGHT[:12] + "A" + RIGHT[13:])).otherwise(F.lit(RIGHT))
    return table(spark, sf_dir, "part").select(k.alias("read"), F.concat(front, left, barcode, right, _bases(10 + k % 20, k + 3)).alias("sequence"))


_HANDLES = "[" + ", ".join(f"'{s}'" for s in HANDLES) + f"][p_partkey % {len(HANDLES)} + 1]"
_E1, _E2 = int(len(LEFT) * trim.ERROR_RATE + 1e-9), int(len(RIGHT) * trim.ERROR_RATE + 1e-9)
PART_READS = f"""
parts AS (
  SELECT p_partkey AS read, substr('GATTACA', 1, CAST(p_partkey % 6 AS INT)) || {_HANDLES} ||
    CASE WHEN p_partkey % 19 = 0 THEN 'ACGTNACGTACGTACGTACG' ELSE {_sql_bases("18 + p_partkey % 5", "p_partkey")} END ||
    CASE WHEN p_partkey % 23 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN '{RIGHT[:12] + "A" + RIGHT[13:]}' ELSE '{RIGHT}' END ||
    {_sql_bases("10 + p_partkey % 20", "(p_partkey + 3)")} AS sequence
  FROM part),
firsts AS (SELECT read, substr(sequence, 1, {len(LEFT) + trim.MAX_SHIFT + _E1}) AS sequence FROM parts),
{_table_of("left_cells", "firsts", LEFT)}, {_whole("left_match", "left_cells", LEFT)},
rests AS (
  SELECT read, end_at AS after, substr(sequence, end_at + 1, {trim.BARCODE_LENGTHS[1] + len(RIGHT) + _E2}) AS sequence
  FROM parts JOIN left_match USING (read) WHERE begin_at <= {trim.MAX_SHIFT}),
{_table_of("right_cells", "(SELECT read, sequence FROM rests)", RIGHT)}, {_whole("right_match", "right_cells", RIGHT)}"""


@CATALOG.query(
    "barcodes_between_handles",
    f"""WITH RECURSIVE {PART_READS},
    found AS (SELECT read, substr(r.sequence, 1, m.begin_at) AS code, r.after + m.end_at AS insert_begin FROM rests r JOIN right_match m USING (read))
    SELECT read, CASE WHEN length(code) BETWEEN 19 AND 21 AND NOT contains(code, 'N') THEN code END AS barcode, CAST(insert_begin AS INT) AS insert_begin,
           substr(sequence, coalesce(insert_begin, 0) + 1) AS kept
    FROM parts LEFT JOIN found USING (read)""",
)
def barcodes_between_handles(spark, sf_dir):
    """Barcodes between two handles with errors, and the insert behind them."""
    found = trim.find_barcode(part_reads(spark, sf_dir))
    return found.select("read", "barcode", "insert_begin", F.expr("substring(sequence, coalesce(insert_begin, 0) + 1)").alias("kept"))
