"""Text formats: lines are written out of the tables by Spark and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.barcode_queries import SPACE, dna_sql
from tagweave.catalog.variant_queries import _sql_view, order_variants
from tagweave.catalog.views import table
from tagweave.functions import dna
from tagweave.sinks.tables import metric_table
from tagweave.sources import genomics, reports, sequences

CATALOG = Catalog()


def spelled(rows, key: str, parts, path=None):
    """Numbered lines: each row contributes ``parts``, ordered by its integer ``key``."""
    path = F.lit("f") if path is None else path
    each = rows.select(path.alias("path"), F.col(key).alias("_k"), F.posexplode(F.array(*parts)).alias("_i", "line"))
    return each.select("path", (F.col("_k") * len(parts) + F.col("_i")).alias("line_no"), "line")


@CATALOG.query(
    "fastq_pairs",
    f"""SELECT 'o' || CAST(o_orderkey AS VARCHAR) || ' 1:N' AS name, {dna_sql(f'o_custkey * 104729 % {SPACE}')} AS r1_seq,
      'o' || CAST(o_orderkey AS VARCHAR) || ' 2:N' AS name2, repeat('F', 10) AS r2_qual FROM orders""",
)
def fastq_pairs(spark, sf_dir):
    """Interleaved FASTQ lines to read pairs."""
    name = F.concat(F.lit("@o"), F.col("o_orderkey").cast("string"))
    bases = dna.base4(F.col("o_custkey") * 104729 % SPACE, 10)
    qual = F.repeat(F.lit("F"), F.lit(10))
    parts = [F.concat(name, F.lit(" 1:N")), bases, F.lit("+"), qual, F.concat(name, F.lit(" 2:N")), dna.reverse_complement(bases), F.lit("+"), qual]
    text = spelled(table(spark, sf_dir, "orders"), "o_orderkey", parts)
    pairs = sequences.interleaved_pairs(sequences.parse_fastq(text))
    return pairs.select("name", "r1_seq", "name2", "r2_qual")


@CATALOG.query(
    "fastq_parallel",
    """SELECT CAST(o_orderkey % 3 AS INTEGER) AS file, o_orderkey // 3 AS record, 'o' || CAST(o_orderkey AS VARCHAR) || ' 1' AS name,
      'o' || CAST(o_orderkey AS VARCHAR) || ' 2' AS name2, CAST(o_custkey AS VARCHAR) AS r1_seq, CAST(o_custkey + 1 AS VARCHAR) AS r2_seq
    FROM orders""",
)
def fastq_parallel(spark, sf_dir):
    """Two parallel sets of three FASTQ files, records numbered anew in each, to read pairs."""

    def side(folder: str, suffix: str, sequence):
        parts = [F.concat(F.lit("@o"), F.col("o_orderkey").cast("string"), F.lit(suffix)), sequence.cast("string"), F.lit("+"), F.lit("F")]
        rows = table(spark, sf_dir, "orders").withColumn("_row", F.expr("o_orderkey div 3"))
        path = F.concat(F.lit(folder), (F.col("o_orderkey") % 3).cast("string"))
        return sequences.parse_fastq(spelled(rows, "_row", parts, path))

    pairs = sequences.parallel_pairs(side("one/", " 1", F.col("o_custkey")), side("two/", " 2", F.col("o_custkey") + 1))
    return pairs.select("file", "record", "name", "name2", "r1_seq", "r2_seq")


@CATALOG.query(
    "sam_parse",
    """SELECT 'e' || CAST(event_id AS VARCHAR) AS qname, CAST(event_id % 2048 AS INTEGER) AS flag,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS rname,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id * 10 END AS start,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id * 10 + 50 + event_id % 7 + 3 + 40 END AS "end",
      CASE WHEN event_id % 4 <> 0 THEN 'BC' || CAST(user_id AS VARCHAR) || '-1' END AS bx,
      CASE WHEN event_id % 5 = 0 THEN event_id // 5 END AS mi, 'i:' || CAST(event_id % 3 AS VARCHAR) AS nm FROM events""",
)
def sam_parse(spark, sf_dir):
    """SAM text to alignment columns, after a round trip through the writer."""
    e = F.col("event_id")
    off = e % 9 == 0
    cigar = F.concat(F.lit("5S50M2I"), (e % 7).cast("string"), F.lit("D3N40M1H"))
    line = F.concat_ws(
        "\t", F.concat(F.lit("e"), e.cast("string")), (e % 2048).cast("string"), F.when(off, "*").otherwise(F.col("event_type")),
        F.when(off, 0).otherwise(e * 10 + 1).cast("string"), F.lit("60"), F.when(off, "*").otherwise(cigar), F.lit("="),
        F.when(off, 0).otherwise(e * 10 + 301).cast("string"), F.lit("400"), F.lit("ACGT"), F.lit("FFFF"),
        F.when(e % 4 != 0, F.concat(F.lit("BX:Z:BC"), F.col("user_id").cast("string"), F.lit("-1"))),
        F.when(e % 5 == 0, F.concat(F.lit("MI:i:"), F.expr("event_id div 5").cast("string"))),
        F.concat(F.lit("NM:i:"), (e % 3).cast("string")),
    )
    text = table(spark, sf_dir, "events").select(line.alias("line"))
    again = genomics.parse_sam(genomics.parse_sam(text).select(genomics.sam_line().alias("line")))
    return again.select("qname", "flag", "rname", "start", "end", "bx", "mi", F.col("tags")["NM"].alias("nm"))


@CATALOG.query(
    "vcf_parse",
    f"""WITH {_sql_view('v', False)} SELECT chrom, pos, ref, array_to_string(alts, ',') AS alts, CAST(g0 AS INTEGER) AS g0,
      CAST(g1 AS INTEGER) AS g1, phased, ps, CAST(o_custkey % 200 AS DOUBLE) AS qual, CAST(o_orderkey % 7 AS VARCHAR) AS dp
    FROM v JOIN orders ON o_orderkey = pos""",
)
def vcf_parse(spark, sf_dir):
    """VCF text to variant columns."""
    v = order_variants(spark, sf_dir)
    bar = F.when(F.col("phased"), "|").otherwise("/")
    gt = F.concat(F.element_at("gt", 1).cast("string"), bar, F.element_at("gt", 2).cast("string"))
    line = F.concat_ws(
        "\t", "chrom", (F.col("pos") + 1).cast("string"), F.lit("."), "ref", F.concat_ws(",", "alts"), F.col("qual").cast("string"),
        F.concat_ws(";", "filter"), F.concat(F.lit("SOMATIC;DP="), (F.col("pos") % 7).cast("string")), F.lit("GT:PS"),
        F.concat(gt, F.lit(":"), F.coalesce(F.col("ps").cast("string"), F.lit("."))),
    )
    parsed = genomics.parse_vcf(v.select(line.alias("line")))
    return parsed.select(
        "chrom", "pos", "ref", F.concat_ws(",", "alts").alias("alts"), F.element_at("gt", 1).alias("g0"),
        F.element_at("gt", 2).alias("g1"), "phased", "ps", "qual", F.col("info")["DP"].alias("dp"),
    )


@CATALOG.query(
    "sv_table_parse",
    """SELECT l_returnflag AS chr1, l_partkey AS break1, CAST(floor(l_quantity) AS BIGINT) AS split_molecules,
      count(*) AS n FROM lineitem GROUP BY ALL""",
)
def sv_table_parse(spark, sf_dir):
    """Structural variant table text to typed calls."""
    line = F.concat_ws(
        "\t", "l_returnflag", F.col("l_partkey").cast("string"), F.lit("X"), (F.col("l_partkey") + 5).cast("string"),
        F.col("l_quantity").cast("string"), F.lit("3.0"), F.lit("+-"), F.lit("1,2"), F.lit("9.5"), F.lit("PASS"),
    )
    calls = genomics.parse_sv_calls(table(spark, sf_dir, "lineitem").select(line.alias("line")))
    return calls.groupBy("chr1", "break1", "split_molecules").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query(
    "phase_text_parse",
    """SELECT o_custkey AS snv_span, CAST(o_orderkey % 50 AS BIGINT) AS phased_snvs, CAST(floor(o_totalprice) AS BIGINT) AS length,
      CAST(o_orderkey % 5 AS BIGINT) AS fragments FROM orders""",
)
def phase_text_parse(spark, sf_dir):
    """Assembler block lines among variant lines."""
    o = F.col("o_orderkey")
    head = F.concat(
        F.lit("BLOCK: offset: "), o.cast("string"), F.lit(" len: "), F.col("o_custkey").cast("string"), F.lit(" phased: "),
        (o % 50).cast("string"), F.lit(" SPAN: "), F.floor("o_totalprice").cast("string"), F.lit(" fragments "), (o % 5).cast("string"),
    )
    text = table(spark, sf_dir, "orders").select(F.explode(F.array(head, F.lit("1\t0\t1\tchr1"), F.lit("********"))).alias("line"))
    return genomics.parse_phase_blocks(text)


@CATALOG.query(
    "run_log_parse",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) || '.log' AS path, x.parameter,
      CASE x.parameter WHEN 'total_reads' THEN CAST(c_custkey * 1234 AS DOUBLE) ELSE CAST(c_nationkey AS DOUBLE) END AS value
    FROM customer, (VALUES ('total_reads'), ('unmapped_reads')) x(parameter)""",
)
def run_log_parse(spark, sf_dir):
    """Counters of many run logs."""
    parts = [
        F.lit("INFO: started"), F.lit("========="), F.lit("STATS SUMMARY - tool.step"), F.lit("---------"),
        F.concat(F.lit("Total reads       "), F.format_number(F.col("c_custkey") * 1234, 0)),
        F.concat(F.lit("Unmapped reads        "), F.col("c_nationkey").cast("string")), F.lit("========="), F.lit("Late  1"),
    ]
    path = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".log"))
    return reports.parse_run_log(spelled(table(spark, sf_dir, "customer"), "c_custkey", parts, path))


@CATALOG.query(
    "run_log_table",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) || '.log' AS "Sample", CAST(c_custkey * 1234 AS DOUBLE) AS total_reads,
      CAST(c_nationkey AS DOUBLE) AS unmapped_reads FROM customer""",
)
def run_log_table(spark, sf_dir):
    """Run logs as one row per sample."""
    return metric_table(run_log_parse(spark, sf_dir), ["total_reads", "unmapped_reads"])


@CATALOG.query(
    "phasing_report_parse",
    """SELECT 's' || CAST(o_orderkey % 20 AS VARCHAR) AS path, 'chr' || CAST(o_orderkey AS VARCHAR) AS chrom, x.metric,
      CASE x.metric WHEN 'N50' THEN CAST(o_custkey AS DOUBLE) ELSE CAST(o_orderkey % 9 AS DOUBLE) END AS value
    FROM orders, (VALUES ('N50'), ('switch rate')) x(metric) WHERE NOT (x.metric = 'switch rate' AND o_custkey % 4 = 0)""",
)
def phasing_report_parse(spark, sf_dir):
    """Sectioned phasing reports: the chromosome is carried from its header line."""
    parts = [
        F.concat(F.lit("----------- chr"), F.col("o_orderkey").cast("string"), F.lit(" -----------")),
        F.concat(F.lit("switch rate:        "), F.when(F.col("o_custkey") % 4 == 0, "n/a").otherwise((F.col("o_orderkey") % 9).cast("string"))),
        F.concat(F.lit("N50:                "), F.col("o_custkey").cast("string")),
    ]
    path = F.concat(F.lit("s"), (F.col("o_orderkey") % 20).cast("string"))
    return reports.parse_phasing_report(spelled(table(spark, sf_dir, "orders"), "o_orderkey", parts, path))


@CATALOG.query(
    "sectioned_stats_parse",
    """WITH c AS (SELECT c_mktsegment AS path, c_nationkey AS bin, count(*) AS n FROM customer GROUP BY ALL)
    SELECT path, CAST(bin AS DOUBLE) AS bin, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY path), 6) AS percent FROM c""",
)
def sectioned_stats_parse(spark, sf_dir):
    """Counts of one section of statistics files as percentages."""
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("path"), F.col("c_nationkey").cast("long").alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )
    parts = [F.concat_ws("\t", F.lit("MB"), F.col("k").cast("string"), F.col("n").cast("string")), F.lit("# note"), F.lit("SN\tNumber of things\t7")]
    text = spelled(counts, "k", parts, F.col("path"))
    return reports.section_percent(text, "MB").withColumn("percent", F.round("percent", 6))


@CATALOG.query(
    "haplotag_log_parse",
    """SELECT CAST(s_suppkey AS VARCHAR) AS path, x.parameter,
      round(CASE x.parameter WHEN 'Total alignments processed' THEN s_suppkey * 10 + 7
        WHEN 'Alignments that could be tagged' THEN s_suppkey * 3 ELSE 100.0::DOUBLE * s_suppkey * 3 / (s_suppkey * 10 + 7) END, 6) AS value
    FROM supplier, (VALUES ('Total alignments processed'), ('Alignments that could be tagged'), ('% tagged')) x(parameter)""",
)
def haplotag_log_parse(spark, sf_dir):
    """Tagging logs with the share of tagged alignments."""
    s = F.col("s_suppkey")
    parts = [
        F.lit("Found: 3 samples"), F.lit("== SUMMARY =="),
        F.concat(F.lit("Total alignments processed:      "), (s * 10 + 7).cast("string")),
        F.concat(F.lit("Alignments that could be tagged:  "), (s * 3).cast("string")),
        F.lit("haplotag - total processing time: 0.1"),
    ]
    text = spelled(table(spark, sf_dir, "supplier"), "s_suppkey", parts, s.cast("string"))
    return reports.parse_haplotag_log(text).withColumn("value", F.round("value", 6))


@CATALOG.query(
    "phased_snv_share",
    """WITH s AS (SELECT o_orderstatus AS sample, o_orderpriority AS chromosome, count(*) AS het,
        count(*) FILTER (o_custkey % 5 <> 0) AS phased FROM orders GROUP BY ALL)
    SELECT sample, round(100.0::DOUBLE * sum(phased) / sum(het), 6) AS percent_snvs_phased,
      round(sum(het) / 1000000, 9) AS million_snvs, round(sum(phased) / 1000000, 9) AS million_phased_snvs
    FROM s WHERE chromosome IN ('1-URGENT', '2-HIGH') GROUP BY sample""",
)
def phased_snv_share(spark, sf_dir):
    """Phased share over chosen chromosomes of per-chromosome statistics."""
    stats = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("sample"), F.col("o_orderpriority").alias("chromosome"))
        .agg(F.count(F.lit(1)).alias("heterozygous_snvs"), F.count_if(F.col("o_custkey") % 5 != 0).alias("phased_snvs"))
    )
    got = reports.phased_snv_totals(stats, ["1-URGENT", "2-HIGH"])
    return got.select("sample", F.round("percent_snvs_phased", 6).alias("percent_snvs_phased"),
                      F.round("million_snvs", 9).alias("million_snvs"), F.round("million_phased_snvs", 9).alias("million_phased_snvs"))


@CATALOG.query(
    "gfa_gaps_parse",
    """SELECT 'chr' || CAST(s_nationkey AS VARCHAR) || '_0-' || CAST(s_suppkey AS VARCHAR) || '-L' AS left_name, '+' AS left_orient,
      's' || CAST(s_suppkey AS VARCHAR) AS right_name, '-' AS right_orient, CAST(s_suppkey % 9 AS BIGINT) AS distance FROM supplier""",
)
def gfa_gaps_parse(spark, sf_dir):
    """Gap lines of assembly graphs."""
    s = F.col("s_suppkey").cast("string")
    line = F.concat_ws("\t", F.lit("G"), F.lit("*"), F.concat(F.lit("chr"), F.col("s_nationkey").cast("string"), F.lit("_0-"), s, F.lit("-L+")),
                       F.concat(F.lit("s"), s, F.lit("-")), (F.col("s_suppkey") % 9).cast("string"), F.lit("*"))
    text = table(spark, sf_dir, "supplier").select(F.explode(F.array(line, F.lit("S\tx\t1\t*"))).alias("line"))
    got = genomics.parse_gfa_gaps(text)
    return got.select(F.col("left").alias("left_name"), "left_orient", F.col("right").alias("right_name"), "right_orient", "distance")
