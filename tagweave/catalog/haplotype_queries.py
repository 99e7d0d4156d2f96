"""Queries on reads with bases: haplotypes, fragments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.variant_queries import _sql_view, order_variants
from tagweave.catalog.views import table
from tagweave.operators import coverage
from tagweave.operators import haplotag as hap
from tagweave.operators import pair_duplicates as pairs
from tagweave.sinks import layouts

CATALOG = Catalog()
DISTANCE = 300
CHROMOSOMES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Shapes of alignments: CIGAR, bases of the reference covered, and the aligned stretches (read place, offset from the start, length).
SHAPES = [
    ("40M", 40, [(0, 0, 40)]),
    ("5S20M2I13M", 33, [(5, 0, 20), (27, 20, 13)]),
    ("18M3D22M", 43, [(0, 0, 18), (18, 21, 22)]),
    ("10H12M100N28M", 140, [(0, 0, 12), (12, 112, 28)]),
]


def line_reads(spark, sf_dir):
    """Line items as alignments with bases: the reference repeats ACGT, and reads differ from it at places that follow their supplier."""
    shape = (F.col("l_partkey") + F.col("l_linenumber")) % len(SHAPES)
    start = F.col("l_orderkey") + F.col("l_partkey") % 40

    def by_shape(values):
        out = F.when(F.lit(False), values[0])
        for k, value in enumerate(values):
            out = out.when(F.col("shape") == k, value)
        return out

    # What reads show follows the place by a period of 20 bases, and places without a base of the reference show T.
    shown = F.element_at(F.array(*[F.lit(_shown(turn) * 3) for turn in (*range(5), None)]), (F.coalesce(F.col("turn"), F.lit(5)) + 1).cast("int"))

    def bases(stretches):
        parts, done = [], 0
        for place, at, length in stretches:
            parts += [F.lit("T" * (place - done)), F.substring(shown, ((F.col("start") + at) % 20 + 1).cast("int"), F.lit(length))]
            done = place + length
        return F.concat(*parts, F.lit("T" * (40 - done)))

    marks = "".join(chr(33 + i * 3 % 40) for i in range(80))
    rows = table(spark, sf_dir, "lineitem").withColumns({"shape": shape, "start": start, "turn": (F.col("l_suppkey") + F.col("l_linenumber")) % 5})
    return rows.select(
        F.concat(F.lit("q"), (F.col("l_orderkey") * 8 + F.floor(F.col("l_linenumber") / 2)).cast("string")).alias("qname"),
        (F.when(F.col("l_partkey") % 17 == 0, 1024).otherwise(0) + F.when(F.col("l_suppkey") % 29 == 0, 256).otherwise(0)).cast("int").alias("flag"),
        F.element_at(F.array(*map(F.lit, CHROMOSOMES)), (F.col("l_suppkey") % 5 + 1).cast("int")).alias("rname"),
        "start",
        (F.col("start") + by_shape([F.lit(s[1]) for s in SHAPES])).alias("end"),
        F.col("l_quantity").cast("int").alias("mapq"),
        by_shape([F.lit(s[0]) for s in SHAPES]).alias("cigar"),
        F.coalesce(by_shape([bases(s[2]) for s in SHAPES]), F.lit("T" * 40)).alias("sequence"),
        F.coalesce(F.substring(F.lit(marks), (F.col("l_linenumber") * 15 % 40 + 1).cast("int"), F.lit(40)), F.lit("")).alias("quality"),
        F.when(F.col("l_partkey") % 23 != 0, F.concat(F.lit("b"), (F.col("l_partkey") % 40).cast("string"))).alias("bx"),
    )


def _shown(turn):
    """Bases shown at the places 0 to 19 of the reference, by the turn of a read; None shows the reference."""
    raised = [1, 1, 0, 0, 2]
    return "".join("ACGT"[(at + (0 if turn is None else raised[(at * 7 + turn) % 5])) % 4] for at in range(20))


def _sql_place() -> str:
    cases = []
    for k, (_, _, stretches) in enumerate(SHAPES):
        for place, at, length in stretches:
            cases.append(f'WHEN shape = {k} AND pos - start BETWEEN {at} AND {at + length - 1} THEN pos - start - {at} + {place}')
    return "CASE " + " ".join(cases) + " END"


_LENGTH = "CASE shape " + " ".join(f"WHEN {k} THEN {s[1]}" for k, s in enumerate(SHAPES)) + " END"
_NAMES = "[" + ", ".join(f"'{c}'" for c in CHROMOSOMES) + "]"
READS = f"""
lines AS (SELECT *, (l_partkey + l_linenumber) % {len(SHAPES)} AS shape, l_orderkey + l_partkey % 40 AS start FROM lineitem),
reads AS (
  SELECT row_number() OVER () AS read, 'q' || (l_orderkey * 8 + l_linenumber // 2) AS qname,
         CASE WHEN l_partkey % 17 = 0 THEN 1024 ELSE 0 END + CASE WHEN l_suppkey % 29 = 0 THEN 256 ELSE 0 END AS flag,
         {_NAMES}[l_suppkey % 5 + 1] AS rname, start, start + {_LENGTH} AS "end", CAST(l_quantity AS INT) AS mapq, shape,
         CASE WHEN l_partkey % 23 <> 0 THEN 'b' || (l_partkey % 40) END AS bx, l_suppkey, l_linenumber
  FROM lines),
sessions AS (
  SELECT read, rname, bx, start,
         CASE WHEN coalesce(max("end") OVER (PARTITION BY rname, bx ORDER BY start, read ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                            + {DISTANCE} < start, TRUE) THEN start END AS opens
  FROM reads WHERE bx IS NOT NULL),
units AS (SELECT read, max(opens) OVER (PARTITION BY rname, bx ORDER BY start, read) AS unit FROM sessions),
called AS (SELECT *, [ref] || alts AS alleles FROM v WHERE g0 <> g1 AND len(alts) <= 2
           AND length(([ref] || alts)[g0 + 1]) = 1 AND length(([ref] || alts)[g1 + 1]) = 1),
seen AS (
  SELECT r.rname, r.bx, u.unit, r.qname, r.mapq, s.pos, s.ps, s.idx, s.phased, s.g0, s.g1, s.alleles,
         substr('ACGT', CAST((s.pos + CASE WHEN (s.pos * 7 + l_suppkey + l_linenumber) % 5 < 2 THEN 1
                                      WHEN (s.pos * 7 + l_suppkey + l_linenumber) % 5 = 4 THEN 2 ELSE 0 END) % 4 AS INT) + 1, 1) AS base,
         ({_sql_place()} * 3 + l_linenumber * 5) % 40 AS quality
  FROM reads r LEFT JOIN units u USING (read) JOIN called s ON s.chrom = r.rname AND s.pos >= r.start AND s.pos < r."end"
  WHERE r.flag = 0 AND {_sql_place()} IS NOT NULL),
sided AS (SELECT *, CASE WHEN base = alleles[g0 + 1] THEN 0 WHEN base = alleles[g1 + 1] THEN 1 END AS side FROM seen)
"""


def _single(keys: str, where: str) -> str:
    return f"""(SELECT {keys}, qname, pos, min(side) AS side, max(quality) AS quality, any_value(ps) AS ps, any_value(idx) AS idx,
                any_value(g0 < g1) AS rising
      FROM sided WHERE side IS NOT NULL AND {where} GROUP BY {keys}, qname, pos HAVING min(side) = max(side))"""


def _decision(keys: str, source: str, where: str) -> str:
    return f"""(SELECT {keys}, CASE WHEN balance > 0 THEN 1 ELSE 2 END AS hp, ps, abs(balance) AS pc FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY abs(balance) DESC, ps) AS place FROM (
          SELECT {keys}, ps, CAST(sum(CASE side WHEN 0 THEN quality ELSE -quality END) AS BIGINT) AS balance
          FROM {source} WHERE {where} GROUP BY {keys}, ps)) WHERE place = 1 AND balance <> 0)"""


TAGGED = f"""{_sql_view('v', False)}, {READS},
single AS {_single('rname, bx, unit', 'phased AND ps IS NOT NULL')},
by_unit AS {_decision('rname, bx, unit', 'single', 'unit IS NOT NULL')},
by_name AS {_decision('rname, qname', 'single', 'unit IS NULL')},
tagged AS (
  SELECT r.qname, r.flag, r.rname, r.start, r."end", r.mapq, r.bx, coalesce(u.hp, n.hp) AS hp, coalesce(u.ps, n.ps) AS ps, coalesce(u.pc, n.pc) AS pc
  FROM reads r LEFT JOIN units t USING (read)
  LEFT JOIN by_unit u ON u.rname = r.rname AND u.bx = r.bx AND u.unit = t.unit
  LEFT JOIN by_name n ON t.unit IS NULL AND n.rname = r.rname AND n.qname = r.qname)"""


@CATALOG.query("haplotag_reads", f"WITH {TAGGED} SELECT * FROM tagged")
def haplotag_reads(spark, sf_dir):
    """Every read with the haplotype its molecule or name votes for."""
    tagged = hap.haplotag(line_reads(spark, sf_dir), order_variants(spark, sf_dir), DISTANCE)
    return tagged.select("qname", "flag", "rname", "start", "end", "mapq", "bx", "hp", "ps", "pc")


@CATALOG.query(
    "haplotag_summary",
    f"""WITH {TAGGED} SELECT count(*) AS alignments, count(*) FILTER (flag & 4 = 0) AS mapped, count(hp) AS tagged,
    count(DISTINCT (rname, ps)) FILTER (ps IS NOT NULL) AS phase_sets, 100.0 * count(hp) / count(*) AS tagged_percent FROM tagged""",
)
def haplotag_summary(spark, sf_dir):
    """Counts of a haplotagging run."""
    return hap.haplotag_summary(hap.haplotag(line_reads(spark, sf_dir), order_variants(spark, sf_dir), DISTANCE))


def _fragments(keys: str, name: str, kind: str, barcode: str, single: str) -> str:
    """Fragment lines by gaps and islands over record numbers."""
    return f"""(
  WITH single AS {single},
  kept AS (
    SELECT {keys}, idx, CASE WHEN (balance > 0) = rising THEN '0' ELSE '1' END AS allele, chr(CAST(33 + least(abs(balance), 93) AS INT)) AS mark
    FROM (SELECT {keys}, idx, any_value(rising) AS rising, sum(CASE side WHEN 0 THEN quality ELSE -quality END) AS balance
          FROM single GROUP BY {keys}, idx) WHERE balance <> 0),
  runs AS (SELECT *, idx - row_number() OVER (PARTITION BY {keys} ORDER BY idx) AS run FROM kept),
  blocks AS (SELECT {keys}, min(idx) AS first, string_agg(allele, '' ORDER BY idx) AS alleles, string_agg(mark, '' ORDER BY idx) AS marks
             FROM runs GROUP BY {keys}, run)
  SELECT count(*) || ' ' || {name} || ' {kind} ' || {barcode} || ' -1 ' || string_agg(first || ' ' || alleles, ' ' ORDER BY first)
         || ' ' || string_agg(marks, '' ORDER BY first) AS line
  FROM blocks GROUP BY {keys} HAVING sum(length(alleles)) >= 2)"""


_LINKED = _fragments("rname, bx, unit", "replace(rname, ' ', '_') || ':' || unit || ':' || bx", "2", "bx", _single("rname, bx, unit", "unit IS NOT NULL"))
_LONG = _fragments("rname, qname", "qname", "0", "'-1'", _single("rname", "mapq >= 20"))


@CATALOG.query("linked_fragments", f"WITH {_sql_view('v', False)}, {READS} SELECT line FROM {_LINKED}")
def linked_fragments(spark, sf_dir):
    """Alleles of molecules as fragment lines."""
    found = hap.linked_fragments(line_reads(spark, sf_dir), order_variants(spark, sf_dir), DISTANCE)
    return hap.linked_lines(found)


@CATALOG.query("merged_fragments", f"WITH {_sql_view('v', False)}, {READS} SELECT line FROM {_LINKED} UNION ALL SELECT line FROM {_LONG}")
def merged_fragments(spark, sf_dir):
    """Fragments of molecules and of confident single reads, one after the other."""
    reads, variants = line_reads(spark, sf_dir), order_variants(spark, sf_dir)
    linked, single = hap.linked_fragments(reads, variants, DISTANCE), hap.long_read_fragments(reads, variants)
    return hap.merged_lines(hap.linked_lines(linked), hap.long_lines(single))


@CATALOG.query(
    "fragments_parse",
    f"""WITH {_sql_view('v', False)}, {READS}, f AS (SELECT string_split(line, ' ') AS f FROM {_LINKED})
    SELECT f[2] AS name, f[4] AS barcode, CAST(f[1] AS INT) AS n_blocks, CAST(length(f[-1]) AS BIGINT) AS variants,
           CAST(f[6] AS BIGINT) AS first, f[-1] AS qualities FROM f""",
)
def fragments_parse(spark, sf_dir):
    """Fragment lines read back into blocks."""
    blocks = hap.parse_fragments(linked_fragments(spark, sf_dir))
    return blocks.select(
        "name", "barcode", F.size("blocks").alias("n_blocks"), "variants", F.col("blocks")[0]["first"].alias("first"),
        F.array_join("blocks.qualities", "").alias("qualities"),
    )


def _crowded_reads(spark, sf_dir):
    """The reads above, moved together and turned, so that many share their unclipped ends."""
    moved = F.col("start") % 600
    reads = line_reads(spark, sf_dir)
    return reads.withColumns(
        {
            "end": F.col("end") - moved,
            "start": F.col("start") - moved,
            "flag": (F.col("flag") + F.when(F.col("mapq") % 2 == 0, 16).otherwise(0)).cast("int"),
            "bx": F.when(F.col("mapq") % 3 != 0, F.col("rname")),
        }
    )


CROWDED = f"""{_sql_view('v', False)}, {READS},
moved AS (
  SELECT qname, flag + CASE WHEN mapq % 2 = 0 THEN 16 ELSE 0 END AS flag, rname, start - start % 600 AS start, "end" - start % 600 AS "end",
         shape, CASE WHEN mapq % 3 <> 0 THEN rname ELSE '' END AS code, mapq,
         CAST(list_sum(list_filter(list_transform(range(40), lambda i: (i * 3 + l_linenumber * 5) % 40), lambda q: q >= 15)) AS BIGINT) AS score
  FROM reads),
ended AS (
  SELECT *, row_number() OVER () AS k,
         {{'rname': rname, 'place': CASE WHEN flag & 16 = 0 THEN start - CASE shape WHEN 1 THEN 5 WHEN 3 THEN 10 ELSE 0 END ELSE "end" - 1 END,
           'reverse': flag & 16 <> 0, 'code': code}} AS e
  FROM moved),
good AS (SELECT * FROM ended WHERE flag & 256 = 0),
names AS (SELECT qname, count(*) AS n, min(e) AS low, max(e) AS high, sum(score) AS score FROM good GROUP BY qname),
ranked AS (SELECT *, row_number() OVER (PARTITION BY low, high ORDER BY score DESC, qname) AS place FROM names WHERE n = 2),
single AS (SELECT g.k, g.e, g.score, g.qname, first_value(g.qname) OVER (PARTITION BY g.e ORDER BY g.score DESC, g.qname) AS keep
           FROM good g JOIN names USING (qname) WHERE n <> 2),
again AS (
  SELECT k FROM good JOIN ranked USING (qname) WHERE place > 1
  UNION SELECT k FROM single WHERE qname <> keep OR e IN (SELECT low FROM ranked UNION SELECT high FROM ranked)),
marked AS (SELECT qname, rname, start, "end", mapq, (flag & ~1024) | CASE WHEN k IN (SELECT k FROM again) THEN 1024 ELSE 0 END AS flag FROM ended)"""


@CATALOG.query("mark_pair_duplicates", f"WITH {CROWDED} SELECT * FROM marked")
def mark_pair_duplicates(spark, sf_dir):
    """Reads with duplicates by the unclipped ends of both mates marked."""
    marked = pairs.mark_pair_duplicates(_crowded_reads(spark, sf_dir))
    return marked.select("qname", "rname", "start", "end", "mapq", "flag")


def _mated_reads(spark, sf_dir):
    """The reads above with strands and mates drawn from their places."""
    flag = F.col("flag") + F.when(F.col("mapq") % 2 == 0, 16).otherwise(0) + F.when(F.col("start") % 2 == 0, 64).otherwise(128)
    return line_reads(spark, sf_dir).withColumn("flag", flag.cast("int"))


def _sql_sequence() -> str:
    """Bases of a read, place by place."""
    cases = " ".join(
        f"WHEN shape = {k} AND i BETWEEN {place} AND {place + length - 1} THEN start + i - {place} + {at}"
        for k, (_, _, stretches) in enumerate(SHAPES)
        for place, at, length in stretches
    )
    turn = "(p * 7 + l_suppkey + l_linenumber) % 5"
    base = f"CASE WHEN p IS NULL THEN 'T' ELSE substr('ACGT', CAST((p + CASE WHEN {turn} < 2 THEN 1 WHEN {turn} = 4 THEN 2 ELSE 0 END) % 4 AS INT) + 1, 1) END"
    return f"array_to_string(list_transform(list_transform(range(40), lambda i: CASE {cases} END), lambda p: {base}), '')"


MATED = f"""{_sql_view('v', False)}, {READS},
mated AS (
  SELECT qname || CASE WHEN bx IS NULL THEN '' ELSE chr(9) || 'BX:Z:' || bx END AS name, qname, mapq % 2 = 0 AS turned, start % 2 = 0 AS is_first,
         {_sql_sequence()} AS bases,
         array_to_string(list_transform(range(40), lambda i: chr(CAST(33 + (i * 3 + l_linenumber * 5) % 40 AS INT))), '') AS marks
  FROM reads WHERE flag & 256 = 0),
sequenced AS (SELECT name, qname, is_first, CASE WHEN turned THEN reverse(translate(bases, 'ACGT', 'TGCA')) ELSE bases END AS sequence,
              CASE WHEN turned THEN reverse(marks) ELSE marks END AS quality FROM mated)"""


@CATALOG.query(
    "alignment_fastq",
    f"""WITH {MATED} SELECT '@' || name || chr(10) || sequence || chr(10) || '+' || chr(10) || quality AS record,
    CASE WHEN is_first THEN 1 ELSE 2 END AS read FROM sequenced""",
)
def alignment_fastq(spark, sf_dir):
    """Alignments back as FASTQ records with their barcode."""
    reads = layouts.reads_of_alignments(_mated_reads(spark, sf_dir))
    return reads.select(layouts.fastq_record(F.col("name"), F.col("sequence"), F.col("quality")).alias("record"), "read")


@CATALOG.query(
    "alignment_pairs",
    f"""WITH {MATED}, one AS (SELECT qname FROM sequenced GROUP BY qname HAVING count(*) = 2 AND count(*) FILTER (is_first) = 1)
    SELECT a.name, b.name AS name2, a.sequence AS r1_seq, a.quality AS r1_qual, b.sequence AS r2_seq, b.quality AS r2_qual
    FROM one JOIN sequenced a ON a.qname = one.qname AND a.is_first JOIN sequenced b ON b.qname = one.qname AND NOT b.is_first""",
)
def alignment_pairs(spark, sf_dir):
    """Read pairs put together again from alignments."""
    return layouts.pairs_of_alignments(_mated_reads(spark, sf_dir))


_STRETCHES = " UNION ALL ".join(
    f'SELECT rname, qname, start + {at} AS s, start + {at + length} AS e FROM reads WHERE flag = 0 AND shape = {k}'
    for k, (_, _, stretches) in enumerate(SHAPES)
    for _, at, length in stretches
)


@CATALOG.query(
    "aligned_depth",
    f"""WITH {_sql_view('v', False)}, {READS}, blocks AS ({_STRETCHES}),
    flagged AS (SELECT *, CASE WHEN max(e) OVER (PARTITION BY rname, qname ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= s
                THEN 0 ELSE 1 END AS opens FROM blocks),
    grouped AS (SELECT *, sum(opens) OVER (PARTITION BY rname, qname ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM flagged),
    joined AS (SELECT rname, min(s) AS s, max(e) AS e FROM grouped GROUP BY rname, qname, g),
    steps AS (SELECT rname, place, sum(d) AS d FROM (SELECT rname, s AS place, 1 AS d FROM joined UNION ALL SELECT rname, e, -1 FROM joined)
              GROUP BY rname, place HAVING sum(d) <> 0),
    runs AS (SELECT rname AS chrom, place AS start, lead(place) OVER w AS "end", CAST(sum(d) OVER w AS BIGINT) AS depth FROM steps
             WINDOW w AS (PARTITION BY rname ORDER BY place))
    SELECT * FROM runs WHERE depth > 0""",
)
def aligned_depth(spark, sf_dir):
    """Depth of names over aligned bases: no deletions, overlapping mates once."""
    return coverage.aligned_depth(line_reads(spark, sf_dir))
