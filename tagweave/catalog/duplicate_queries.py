"""Duplicate positions, barcode links, components and duplicate marking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.views import EVENT_READS, event_reads, table
from tagweave.operators import components as cc
from tagweave.operators import duplicates as dup
from tagweave.plans.linked_reads import read_pairs

CATALOG = Catalog()
WINDOW = 1
SMALL = 100000


def line_pairs(spark, sf_dir):
    """Line items as read pairs: supplier = barcode, part = position."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("rname"),
        F.col("l_partkey").alias("start"),
        (F.col("l_partkey") + 3 * F.col("l_linenumber")).alias("end"),
        F.col("l_linestatus").alias("orientation"),
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("bx"),
    )


PAIRS = """pairs AS (SELECT l_returnflag AS rname, l_partkey AS start, l_partkey + 3 * l_linenumber AS "end",
  l_linestatus AS orientation, lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS bx FROM lineitem),
bc AS (SELECT DISTINCT rname, start, "end", orientation, bx FROM pairs),
positions AS (SELECT rname, start, "end", orientation, count(*) AS barcodes FROM bc
              GROUP BY rname, start, "end", orientation HAVING count(*) > 1),
limits AS (SELECT rname, greatest(6, CAST(ceil(quantile_cont(CAST(barcodes AS DOUBLE), 0.99)) AS BIGINT)) AS threshold
           FROM positions GROUP BY rname)"""

EDGES = f"""seeds AS (SELECT bc.* FROM bc JOIN positions p USING (rname, start, "end", orientation)
          JOIN limits l ON l.rname = bc.rname WHERE p.barcodes < l.threshold),
ab AS (SELECT x.rname, x.start, x."end", x.orientation, x.bx AS a, y.bx AS b FROM seeds x JOIN seeds y
       ON x.rname = y.rname AND x.start = y.start AND x."end" = y."end" AND x.orientation = y.orientation AND x.bx < y.bx),
edges AS (SELECT DISTINCT p.a AS src, p.b AS dst FROM ab p JOIN ab q ON p.rname = q.rname AND p.a = q.a AND p.b = q.b
          WHERE (q.start, q."end", q.orientation) < (p.start, p."end", p.orientation)
            AND (p.start - q."end" BETWEEN 0 AND {WINDOW} OR p.start - q."end" BETWEEN -10 AND -8))"""

LABELS = """both_ways AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
reach AS (SELECT src AS node, src AS seen FROM both_ways UNION
          SELECT r.node, e.dst FROM reach r JOIN both_ways e ON e.src = r.seen),
labels AS (SELECT node, min(seen) AS label FROM reach GROUP BY node)"""


@CATALOG.query(
    "pair_mates",
    f"""WITH RECURSIVE {EVENT_READS},
    o AS (SELECT bx, event_id, mapq >= 15 AS q, row_number() OVER (PARTITION BY bx ORDER BY event_id) AS rn
          FROM reads WHERE bx IS NOT NULL),
    w AS (SELECT bx, rn, event_id, q AS waits, CAST(NULL AS BIGINT) AS mate FROM o WHERE rn = 1
          UNION ALL
          SELECT o.bx, o.rn, o.event_id, NOT w.waits AND o.q, CASE WHEN w.waits THEN w.event_id END
          FROM w JOIN o ON o.bx = w.bx AND o.rn = w.rn + 1)
    SELECT bx, event_id AS read_event_id, mate AS mate_event_id FROM w WHERE mate IS NOT NULL""",
)
def pair_mates(spark, sf_dir):
    """Consecutive records of a name paired; only the first must qualify."""
    reads = event_reads(spark, sf_dir).where("bx IS NOT NULL").select("bx", "event_id", "mapq")
    pairs = dup.paired_reads(reads, "event_id", F.col("mapq") >= 15, SMALL, name="bx")
    return pairs.select("bx", "read_event_id", "mate_event_id")


RECORDS = """recs AS (SELECT l_orderkey % 97 AS name, l_returnflag || l_linestatus AS rname, l_partkey AS start, l_suppkey % 61 AS mapq,
    l_partkey + 50 + l_linenumber AS "end", l_quantity,
    CASE WHEN l_linenumber % 2 = 0 THEN 67 ELSE 147 END + CASE WHEN l_orderkey % 11 = 0 THEN 1024 ELSE 0 END
      + CASE WHEN l_suppkey % 13 = 0 THEN 256 ELSE 0 END + CASE WHEN l_suppkey % 7 = 0 THEN 512 ELSE 0 END AS flag,
    lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS bx FROM lineitem),
one AS (SELECT name, rname, start, flag, max(mapq) AS mapq, max("end") AS "end", max(bx) AS bx FROM recs
        GROUP BY name, rname, start, flag)"""


def line_records(spark, sf_dir):
    """Line items as alignments whose names recur on every chromosome; one record per name, place and flag."""
    extra = sum(
        (F.when(F.col(c) % n == 0, bit).otherwise(0) for c, n, bit in (("l_orderkey", 11, 1024), ("l_suppkey", 13, 256), ("l_suppkey", 7, 512))),
        F.lit(0),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_orderkey") % 97).cast("string").alias("qname"),
            F.concat("l_returnflag", "l_linestatus").alias("rname"),
            F.col("l_partkey").alias("start"),
            (F.when(F.col("l_linenumber") % 2 == 0, 67).otherwise(147) + extra).alias("flag"),
        )
        .agg(
            F.max(F.col("l_suppkey") % 61).alias("mapq"),
            F.max(F.col("l_partkey") + 50 + F.col("l_linenumber")).alias("end"),
            F.max(F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("bx"),
        )
    )


@CATALOG.query(
    "proper_pairs",
    f"""WITH RECURSIVE {RECORDS},
    o AS (SELECT *, flag & 4 = 0 AND flag & 8 = 0 AND flag & 2 <> 0 AND mapq >= 5 AS q,
            row_number() OVER (PARTITION BY name ORDER BY rname, start, flag % 4096) AS rn FROM one),
    w AS (SELECT name, rn, q AS waits, CAST(NULL AS BIGINT) AS mate FROM o WHERE rn = 1
          UNION ALL
          SELECT o.name, o.rn, NOT w.waits AND o.q, CASE WHEN w.waits THEN w.rn END
          FROM w JOIN o ON o.name = w.name AND o.rn = w.rn + 1)
    SELECT r.rname, m.start, r."end", CASE WHEN m.flag & 64 <> 0 AND r.flag & 128 <> 0 THEN 'F' ELSE 'R' END AS orientation, r.bx
    FROM w JOIN o r ON r.name = w.name AND r.rn = w.rn JOIN o m ON m.name = w.name AND m.rn = w.mate
    WHERE m.flag & 16 = 0 AND r.flag & 16 <> 0 AND r.rname = m.rname""",
)
def proper_pairs(spark, sf_dir):
    """Forward / reverse pairs of names that are met on several chromosomes."""
    return read_pairs(line_records(spark, sf_dir), 5)


@CATALOG.query("dup_positions", f'WITH {PAIRS} SELECT * FROM positions')
def dup_positions(spark, sf_dir):
    """Positions met with more than one barcode."""
    return dup.duplicate_positions(line_pairs(spark, sf_dir))


@CATALOG.query("dup_threshold", f"WITH {PAIRS} SELECT * FROM limits")
def dup_threshold(spark, sf_dir):
    """Barcode coverage limit per chromosome."""
    return dup.coverage_threshold(dup.duplicate_positions(line_pairs(spark, sf_dir)))


@CATALOG.query("barcode_edges", f"WITH {PAIRS}, {EDGES} SELECT * FROM edges")
def barcode_edges(spark, sf_dir):
    """Barcode links under the transposase rule."""
    return dup.barcode_edges(dup.seed_positions(line_pairs(spark, sf_dir)), "dbs", WINDOW)


@CATALOG.query(
    "barcode_edges_any_overlap",
    f"""WITH {PAIRS}, {EDGES}
    SELECT DISTINCT p.a AS src, p.b AS dst FROM ab p JOIN ab q ON p.rname = q.rname AND p.a = q.a AND p.b = q.b
    WHERE (q.start, q."end", q.orientation) < (p.start, p."end", p.orientation) AND p.start - q."end" <= 2""",
)
def barcode_edges_any_overlap(spark, sf_dir):
    """Barcode links where every overlap is acceptable."""
    return dup.barcode_edges(dup.seed_positions(line_pairs(spark, sf_dir)), "10x", 2)


@CATALOG.query("barcode_components", f"WITH RECURSIVE {PAIRS}, {EDGES}, {LABELS} SELECT * FROM labels")
def barcode_components(spark, sf_dir):
    """Barcodes with the smallest barcode of their component."""
    links = dup.droplet_links(dup.seed_positions(line_pairs(spark, sf_dir)), "dbs", WINDOW)
    return cc.connected_components(links)


@CATALOG.query(
    "barcode_retag",
    f"""WITH RECURSIVE {PAIRS}, {EDGES}, {LABELS}
    SELECT coalesce(l.label, p.bx) AS bx, count(*) AS reads FROM pairs p LEFT JOIN labels l ON l.node = p.bx GROUP BY 1""",
)
def barcode_retag(spark, sf_dir):
    """Reads per barcode after merging."""
    pairs = line_pairs(spark, sf_dir)
    labels = cc.connected_components(dup.droplet_links(dup.seed_positions(pairs), "dbs", WINDOW))
    return cc.retag(pairs, labels).groupBy("bx").agg(F.count(F.lit(1)).alias("reads"))


@CATALOG.query(
    "components_merged_chunks",
    """WITH RECURSIVE edges AS (SELECT DISTINCT 's' || CAST(s_suppkey % 40 AS VARCHAR) AS src,
        's' || CAST((s_suppkey * 7 + 3) % 50 + 40 AS VARCHAR) AS dst FROM supplier
      UNION SELECT DISTINCT 's' || CAST(p_size AS VARCHAR), 's' || CAST(p_size // 3 AS VARCHAR) FROM part),
    both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
    reach AS (SELECT src AS node, src AS seen FROM both_ways UNION
              SELECT r.node, e.dst FROM reach r JOIN both_ways e ON e.src = r.seen)
    SELECT node, min(seen) AS label FROM reach GROUP BY node""",
)
def components_merged_chunks(spark, sf_dir):
    """Components of two chunks computed apart, then merged."""

    def named(column):
        return F.concat(F.lit("s"), column.cast("string"))

    one = table(spark, sf_dir, "supplier").select(
        named(F.col("s_suppkey") % 40).alias("src"), named((F.col("s_suppkey") * 7 + 3) % 50 + 40).alias("dst")
    )
    two = (
        table(spark, sf_dir, "part")
        .select(named(F.col("p_size")).alias("src"), named(F.expr("p_size div 3")).alias("dst"))
    )
    return cc.merge_labels(cc.connected_components(one), cc.connected_components(two))


@CATALOG.query(
    "mark_duplicates",
    f"""WITH {EVENT_READS}, k AS (SELECT event_id, coalesce(bx, '') AS bx, rname, start // 43200 AS place,
          event_id % 2 AS strand, mapq FROM reads)
    SELECT event_id, row_number() OVER (PARTITION BY bx, rname, place, strand ORDER BY mapq DESC, event_id) > 1
           AS is_duplicate FROM k""",
)
def mark_duplicates(spark, sf_dir):
    """All but the best read of each (barcode, position, strand)."""
    reads = event_reads(spark, sf_dir).select(
        "event_id",
        F.coalesce("bx", F.lit("")).alias("bx"),
        "rname",
        F.expr("start div 43200").alias("place"),
        (F.col("event_id") % 2).alias("strand"),
        "mapq",
    )
    marked = dup.mark_duplicates(reads, ["bx", "rname", "place", "strand"], "mapq", "event_id")
    return marked.select("event_id", "is_duplicate")
