"""Molecule building and molecule tagging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.views import ANALYZABLE, EVENT_READS, event_reads, reads_of, table
from tagweave.operators import molecules as mol
from tagweave.streaming import strict
from tagweave.streaming.molecules import stream_sessions

CATALOG = Catalog()
WINDOW = 86400 * 3
MIN_READS = 4
MIN_MAPQ = 5

PERMISSIVE = f"""
usable AS (SELECT * FROM reads WHERE {ANALYZABLE.format(min_mapq=MIN_MAPQ)}),
marked AS (
  SELECT *, max("end") OVER (PARTITION BY rname, bx ORDER BY start, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM usable),
flagged AS (SELECT *, CASE WHEN prev IS NULL OR prev + {WINDOW} < start THEN 1 ELSE 0 END AS opens FROM marked),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY rname, bx ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM flagged),
molecules AS (
  SELECT rname, bx, min(start) AS StartPosition, max("end") AS EndPosition,
         count(*) AS Reads, max("end") - min(start) AS Length,
         CAST(sum(CASE WHEN opens = 1 THEN "end" - start
                       ELSE greatest("end" - greatest(start, prev), 0) END) AS BIGINT) AS BpCovered
  FROM numbered GROUP BY rname, bx, sid HAVING count(*) >= {MIN_READS})
"""

# The sequential walk, one row at a time per (chromosome, barcode).
STRICT = f"""
usable AS (
  SELECT rname, bx, start, "end", qname,
         row_number() OVER (PARTITION BY rname, bx ORDER BY start, "end", qname) AS rn
  FROM reads WHERE {ANALYZABLE.format(min_mapq=MIN_MAPQ)}),
walk AS (
  SELECT rname, bx, rn, start AS mol_start, "end" AS stop, [qname] AS names, TRUE AS ok, "end" - start AS gain
  FROM usable WHERE rn = 1
  UNION ALL
  SELECT u.rname, u.bx, u.rn,
         CASE WHEN w.stop + {WINDOW} < u.start THEN u.start ELSE w.mol_start END,
         CASE WHEN w.stop + {WINDOW} < u.start THEN u."end"
              WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 8 AND 10
              THEN greatest(w.stop, u."end") ELSE w.stop END,
         CASE WHEN w.stop + {WINDOW} < u.start THEN [u.qname]
              WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 8 AND 10
              THEN list_append(w.names, u.qname) ELSE w.names END,
         w.stop + {WINDOW} < u.start OR list_contains(w.names, u.qname) OR w.stop < u.start
              OR w.stop - u.start BETWEEN 8 AND 10,
         CASE WHEN w.stop + {WINDOW} < u.start THEN u."end" - u.start
              WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 8 AND 10
              THEN greatest(u."end" - greatest(u.start, w.stop), 0) ELSE 0 END
  FROM walk w JOIN usable u ON u.rname = w.rname AND u.bx = w.bx AND u.rn = w.rn + 1),
placed AS (SELECT u.*, w.mol_start, w.gain FROM usable u JOIN walk w USING (rname, bx, rn) WHERE w.ok)
"""

MOLECULE_COLUMNS = ["rname", "bx", "StartPosition", "EndPosition", "Reads", "Length", "BpCovered"]


@CATALOG.query("molecule_sessions", f"WITH {EVENT_READS}, {PERMISSIVE} SELECT * FROM molecules")
def molecule_sessions(spark, sf_dir):
    """Molecules where any overlap is accepted."""
    return mol.build_molecules(event_reads(spark, sf_dir), "10x", WINDOW, MIN_READS, MIN_MAPQ)


@CATALOG.query(
    "molecule_sessions_narrow",
    f"""WITH {EVENT_READS}, {PERMISSIVE.replace(str(WINDOW), "900").replace(f"count(*) >= {MIN_READS}", "count(*) >= 2")}
    SELECT * FROM molecules""",
)
def molecule_sessions_narrow(spark, sf_dir):
    """Molecules under a narrow window, linked over bucket borders."""
    return mol.build_molecules(event_reads(spark, sf_dir), "10x", 900, 2, MIN_MAPQ)


@CATALOG.query(
    "molecule_session_windows",
    f"WITH {EVENT_READS}, {PERMISSIVE} SELECT rname, bx, StartPosition, EndPosition, Reads FROM molecules",
)
def molecule_session_windows(spark, sf_dir):
    """The streaming form of molecule building, run on the whole table as a batch."""
    return stream_sessions(event_reads(spark, sf_dir), WINDOW, MIN_MAPQ).where(F.col("Reads") >= MIN_READS)


STRICT_MOLECULES = f"""WITH RECURSIVE {EVENT_READS}, {STRICT}
    SELECT rname, bx, mol_start AS StartPosition, max("end") AS EndPosition, count(*) AS Reads,
           max("end") - mol_start AS Length, CAST(sum(gain) AS BIGINT) AS BpCovered
    FROM placed GROUP BY rname, bx, mol_start HAVING count(*) >= 3"""


@CATALOG.query("molecule_sessions_strict", STRICT_MOLECULES)
def molecule_sessions_strict(spark, sf_dir):
    """Molecules under the transposase overlap rule."""
    return mol.build_molecules(event_reads(spark, sf_dir), "dbs", WINDOW, 3, MIN_MAPQ)


@CATALOG.query("molecule_stream_strict", STRICT_MOLECULES)
def molecule_stream_strict(spark, sf_dir):
    """The same molecules from a stream over the events, folded behind the watermark."""
    folder = strict.new_folder(spark)
    schema = table(spark, sf_dir, "events").schema
    # A pattern, as a stream's path may only name one file that way.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    reads = strict.with_end(reads_of(events), f"{folder}/end")
    strict.run_available(strict.stream_molecules(reads, "dbs", WINDOW, 3, MIN_MAPQ), folder)
    return spark.read.schema(strict.MOLECULES).parquet(f"{folder}/molecules")


@CATALOG.query(
    "read_molecules",
    f"""WITH RECURSIVE {EVENT_READS},
    usable AS (
      SELECT rname, bx, start, "end", qname, start // 5000000 AS mi,
             row_number() OVER (PARTITION BY rname, bx, start // 5000000 ORDER BY start, "end", qname) AS rn
      FROM reads WHERE {ANALYZABLE.format(min_mapq=0)}),
    walk AS (
      SELECT rname, bx, mi, rn, start AS first_start, "end" AS stop, [qname] AS names, TRUE AS ok, "end" - start AS gain
      FROM usable WHERE rn = 1
      UNION ALL
      SELECT u.rname, u.bx, u.mi, u.rn, w.first_start,
             CASE WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 4 AND 6
                  THEN greatest(w.stop, u."end") ELSE w.stop END,
             CASE WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 4 AND 6
                  THEN list_append(w.names, u.qname) ELSE w.names END,
             list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 4 AND 6,
             CASE WHEN list_contains(w.names, u.qname) OR w.stop < u.start OR w.stop - u.start BETWEEN 4 AND 6
                  THEN greatest(u."end" - greatest(u.start, w.stop), 0) ELSE 0 END
      FROM walk w JOIN usable u ON u.rname = w.rname AND u.bx = w.bx AND u.mi = w.mi AND u.rn = w.rn + 1)
    SELECT w.rname, w.bx, w.mi, w.first_start AS StartPosition, max(u."end") AS EndPosition, count(*) AS Reads,
           max(u."end") - w.first_start AS Length, CAST(sum(w.gain) AS BIGINT) AS BpCovered
    FROM walk w JOIN usable u USING (rname, bx, mi, rn)
    WHERE w.ok GROUP BY w.rname, w.bx, w.mi, w.first_start HAVING count(*) >= 2""",
)
def read_molecules(spark, sf_dir):
    """Molecules of reads that already carry a molecule number."""
    reads = event_reads(spark, sf_dir).withColumn("mi", F.expr("start div 5000000"))
    return mol.read_molecules(reads, "tellseq", min_reads=2)


@CATALOG.query(
    "molecule_summary",
    f"""WITH {EVENT_READS}, {PERMISSIVE},
    ranked AS (SELECT Length, sum(Length) OVER (ORDER BY Length DESC ROWS UNBOUNDED PRECEDING) AS cs,
                      sum(Length) OVER () AS total FROM molecules)
    SELECT CAST(count(*) AS BIGINT) AS molecules, round(avg(Length), 6) AS mean_length, max(Length) AS longest,
           round(avg(100.0::DOUBLE * BpCovered / Length), 6) AS mean_coverage,
           (SELECT max(Length) FROM ranked WHERE cs >= floor(total / 2)) AS n50_length,
           round(quantile_cont(CAST(Length AS DOUBLE), 0.5), 6) AS median_length,
           round(quantile_cont(100.0::DOUBLE * BpCovered / Length, 0.5), 6) AS median_coverage
    FROM molecules""",
)
def molecule_summary(spark, sf_dir):
    """N50, mean, median and longest molecule; coverage."""
    summary = mol.molecule_summary(mol.build_molecules(event_reads(spark, sf_dir), "10x", WINDOW, MIN_READS, MIN_MAPQ))
    rounded = {"mean_length", "mean_coverage", "median_length", "median_coverage"}
    return summary.select(*[F.round(c, 6).alias(c) if c in rounded else c for c in summary.columns])


@CATALOG.query(
    "molecules_filtered",
    f"""WITH {EVENT_READS}, {PERMISSIVE},
    bad AS (SELECT bx FROM molecules GROUP BY bx HAVING count(*) > 8)
    SELECT * FROM molecules WHERE bx NOT IN (SELECT bx FROM bad)""",
)
def molecules_filtered(spark, sf_dir):
    """Molecules of barcodes with at most 8 molecules."""
    molecules = mol.build_molecules(event_reads(spark, sf_dir), "10x", WINDOW, MIN_READS, MIN_MAPQ)
    kept = mol.without_barcodes(molecules, mol.crowded_barcodes(molecules, 8))
    return kept.select(*MOLECULE_COLUMNS)


@CATALOG.query(
    "read_molecule_tag",
    f"""WITH {EVENT_READS}, {PERMISSIVE},
    members AS (
      SELECT n.pair, m.rname, m.EndPosition, m.StartPosition, m.bx
      FROM numbered n JOIN molecules m ON n.rname = m.rname AND n.bx = m.bx
           AND n.start BETWEEN m.StartPosition AND m.EndPosition),
    tags AS (
      SELECT pair, arg_max(StartPosition, (rname, EndPosition, StartPosition, bx)) AS mi FROM members GROUP BY pair)
    SELECT r.event_id, r.pair AS qname, r.rname, r.bx, CAST(coalesce(t.mi, -1) AS BIGINT) AS mi
    FROM reads r LEFT JOIN tags t ON r.pair = t.pair""",
)
def read_molecule_tag(spark, sf_dir):
    """Every read with the molecule of its name, -1 for none."""
    reads = event_reads(spark, sf_dir).withColumn("qname", F.col("pair"))
    tagged = mol.tag_reads(reads, "10x", WINDOW, MIN_READS, MIN_MAPQ)
    return tagged.select("event_id", "qname", "rname", "bx", F.col("mi").cast("long").alias("mi"))


@CATALOG.query(
    "molecule_numbering",
    f"""WITH {EVENT_READS}, {PERMISSIVE}
    SELECT rname AS Chromosome, bx AS Barcode, StartPosition, count(*) OVER () AS molecules,
           'Reads=' || CAST(Reads AS VARCHAR) || ';Length=' || CAST(Length AS VARCHAR)
             || ';BpCovered=' || CAST(BpCovered AS VARCHAR) AS Info
    FROM molecules""",
)
def molecule_numbering(spark, sf_dir):
    """BED-like molecule rows; the dense numbering must span exactly 1..n."""
    from tagweave.sinks.tables import molecule_bed

    molecules = mol.molecule_table(
        mol.build_molecules(event_reads(spark, sf_dir), "10x", WINDOW, MIN_READS, MIN_MAPQ)
    )
    bed = molecule_bed(molecules)
    span = bed.agg(F.max("MoleculeID") - F.min("MoleculeID") + 1).scalar()
    return bed.select("Chromosome", "Barcode", "StartPosition", span.alias("molecules"), "Info")
