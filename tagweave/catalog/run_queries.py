"""Results of several runs merged, and tables written and read again in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.interval_queries import CATALOG as INTERVALS
from tagweave.catalog.variant_queries import order_variants
from tagweave.catalog.views import EVENT_READS, event_reads, table
from tagweave.operators import merging, statistics, structural
from tagweave.operators.reads import drop_phasing_tags
from tagweave.session import shared_folder
from tagweave.sinks import layouts
from tagweave.sinks import tables as sinks
from tagweave.sources import genomics, reports, sequences, tables

CATALOG = Catalog()


def new_folder(spark) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_folder(spark)}/tables-{uuid4().hex}"


def order_molecules(spark, sf_dir):
    """Orders as molecules of three runs, each numbered from 1."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        (o % 3).cast("int").alias("run"),
        F.expr("o_orderkey div 3 + 1").alias("MoleculeID"),
        F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("Barcode"),
        (o % 9).alias("Reads"),
        F.col("o_custkey").alias("Length"),
        F.expr("o_custkey div 2").alias("BpCovered"),
    )


@CATALOG.query(
    "merged_molecule_tables",
    """WITH m AS (SELECT CAST(o_orderkey % 3 AS INTEGER) AS FileNr, o_orderkey // 3 + 1 AS id, 'b' || CAST(o_custkey AS VARCHAR) AS Barcode,
        o_orderkey % 9 AS Reads, o_custkey AS Length, o_custkey // 2 AS BpCovered FROM orders),
    s AS (SELECT FileNr, coalesce(sum(max(id)) OVER (ORDER BY FileNr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift
          FROM m GROUP BY FileNr)
    SELECT CAST(id + shift AS BIGINT) AS "MoleculeID", Barcode AS "Barcode", Reads AS "Reads", Length AS "Length",
           BpCovered AS "BpCovered", FileNr AS "FileNr" FROM m JOIN s USING (FileNr)""",
)
def merged_molecule_tables(spark, sf_dir):
    """Molecule tables of three runs, written, read together and given identifiers of one range."""
    folder, rows = new_folder(spark), order_molecules(spark, sf_dir)
    for run in range(3):
        sinks.write_tsv(rows.where(F.col("run") == run).drop("run"), f"{folder}/{run}")
    return merging.shifted_ids(tables.read_molecules(spark, [f"{folder}/{run}" for run in range(3)]))


@CATALOG.query(
    "merged_alignments",
    f"""WITH {EVENT_READS} SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN rname END AS rname, start, bx,
      CASE WHEN event_id % 2 = 0 THEN 'a' || CAST(event_id AS VARCHAR) END AS rx FROM reads""",
)
def merged_alignments(spark, sf_dir):
    """Alignments of two runs, one without raw barcodes, in genome order and without phasing tags."""
    reads = event_reads(spark, sf_dir).withColumn("rname", F.when(F.col("event_id") % 17 != 0, F.col("rname")))
    reads = reads.withColumns({"hp": F.lit(1), "ps": F.lit(2), "pc": F.lit(3)})
    one = reads.where("event_id % 2 = 0").withColumn("rx", F.concat(F.lit("a"), F.col("event_id").cast("string")))
    merged = merging.merged_alignments([one, reads.where("event_id % 2 = 1")])
    return merged.select("event_id", "rname", "start", "bx", "rx")


@CATALOG.query(
    "unmapped_reads",
    "SELECT 'e' || CAST(event_id AS VARCHAR) AS qname, CAST(event_id AS INTEGER) AS mi FROM events WHERE event_id % 9 = 0",
)
def unmapped_reads(spark, sf_dir):
    """Records without a position of alignment text, without phasing tags."""
    e = F.col("event_id")
    line = F.concat_ws(
        "\t", F.concat(F.lit("e"), e.cast("string")), F.lit("4"), F.when(e % 9 == 0, "*").otherwise(F.col("event_type")),
        F.lit("7"), F.lit("60"), F.lit("4M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("FFFF"),
        F.concat(F.lit("MI:i:"), e.cast("string")), F.lit("HP:i:1"), F.lit("PS:i:5"), F.lit("PC:i:9"),
    )
    reads = genomics.parse_sam(table(spark, sf_dir, "events").select(line.alias("line")))
    rows = drop_phasing_tags(reads.where(genomics.unmapped()))
    return rows.select("qname", F.col("mi").cast("int").alias("mi"))


@CATALOG.query(
    "ordered_variants",
    "SELECT o_orderpriority AS chrom, o_orderkey AS pos FROM orders",
)
def ordered_variants(spark, sf_dir):
    """Variants of three parts in the order of contigs and positions."""
    variants = order_variants(spark, sf_dir).select("chrom", "pos")
    names = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name")).distinct()
    contigs = names.withColumn("nr", 6 - F.substring("name", 1, 1).cast("int"))
    return merging.ordered_variants([variants.where(F.col("pos") % 3 == part) for part in range(3)], contigs)


@CATALOG.query(
    "contig_lengths",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS name, CAST(c_nationkey * 1000 AS BIGINT) AS fai_length,
      CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey * 1000 AS BIGINT) END AS header_length FROM customer""",
)
def contig_lengths(spark, sf_dir):
    """Contig lengths of an index, and of a header that states only some."""
    customers = table(spark, sf_dir, "customer")
    name, length = F.concat(F.lit("c"), F.col("c_custkey").cast("string")), (F.col("c_nationkey") * 1000).cast("string")
    index = customers.select(F.concat_ws("\t", name, length, F.lit("7\t60\t61")).alias("line"))
    stated = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(",length="), length)).otherwise(F.lit(""))
    header = customers.select(F.concat(F.lit("##contig=<ID="), name, stated, F.lit(">")).alias("line"))
    known = genomics.vcf_contig_lengths(header).select(F.col("chrom").alias("name"), F.col("length").alias("header_length"))
    return genomics.parse_fai(index).withColumnRenamed("length", "fai_length").join(known, "name", "left")


@CATALOG.query(
    "cluster_table",
    """SELECT 'n' || CAST(c_nationkey AS VARCHAR) AS canonical, count(*) AS size,
      list_sort(list('c' || CAST(c_custkey AS VARCHAR))) AS components FROM customer GROUP BY c_nationkey""",
)
def cluster_table(spark, sf_dir):
    """Clusters written as text, largest first, and read again."""
    member = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    clusters = table(spark, sf_dir, "customer").groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("canonical")).agg(
        F.count(F.lit(1)).alias("size"), F.sort_array(F.collect_list(member)).alias("components")
    )
    folder = new_folder(spark)
    sinks.write_clusters(clusters, folder)
    return tables.read_clusters(spark, folder)


@CATALOG.query(
    "merge_list",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS node, 'c' || CAST(c_custkey // 2 AS VARCHAR) AS label FROM customer
    WHERE c_custkey // 2 <> c_custkey""",
)
def merge_list(spark, sf_dir):
    """Merges written as pairs, those into themselves left out, and read again."""
    labels = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.expr("concat('c', c_custkey div 2)").alias("label")
    )
    folder = new_folder(spark)
    sinks.write_merges(labels, folder)
    return tables.read_merges(spark, folder)


@CATALOG.query(
    "word_list",
    """SELECT DISTINCT word AS bx FROM (SELECT UNNEST(string_split(p_name, ' ')) AS word FROM part) WHERE word <> ''""",
)
def word_list(spark, sf_dir):
    """Distinct words of a text file, e.g. a list of barcodes."""
    folder = new_folder(spark)
    table(spark, sf_dir, "part").select(F.col("p_name").alias("value")).write.text(folder)
    return tables.read_words(spark, folder)


@CATALOG.query(
    "fastq_round_trip",
    """SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS read_name, CAST(o_custkey AS VARCHAR) AS raw_barcode,
      'o' || CAST(o_orderkey AS VARCHAR) || ' 2' AS name2, o_orderstatus AS r2_seq FROM orders""",
)
def fastq_round_trip(spark, sf_dir):
    """Read pairs written as two files of one order and read again; the first read taken as a barcode read."""
    key = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    pairs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("place"), F.concat(key, F.lit(" 1")).alias("name"), F.concat(key, F.lit(" 2")).alias("name2"),
        F.col("o_custkey").cast("string").alias("r1_seq"), F.lit("F").alias("r1_qual"),
        F.col("o_orderstatus").alias("r2_seq"), F.lit("G").alias("r2_qual"),
    )
    folder = new_folder(spark)
    layouts.write_fastq_pairs(pairs, folder)
    again = sequences.read_fastq_pairs(spark, f"{folder}/r1", f"{folder}/r2")
    codes = sequences.barcode_reads(again.select(F.col("name"), F.col("r1_seq").alias("sequence"), "name2", "r2_seq"))
    return codes.hint("merge").join(again.select(F.substring_index("name", " ", 1).alias("read_name"), "name2", "r2_seq"), "read_name")


@CATALOG.query(
    "bin_rows_fastq",
    """SELECT '@o' || CAST(o_orderkey AS VARCHAR) || ':AC BX:Z:AC-1' || chr(10) || CAST(o_custkey AS VARCHAR) || chr(10) || '+' || chr(10) || 'F'
      || chr(10) || '@o' || CAST(o_orderkey AS VARCHAR) || ':AC BX:Z:AC-1' || chr(10) || o_orderstatus || chr(10) || '+' || chr(10) || 'G' AS record
    FROM orders""",
)
def bin_rows_fastq(spark, sf_dir):
    """Bin rows turned back into interleaved FASTQ."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name"), F.lit("AC").alias("barcode"),
        F.col("o_custkey").cast("string").alias("r1_seq"), F.lit("F").alias("r1_qual"),
        F.col("o_orderstatus").alias("r2_seq"), F.lit("G").alias("r2_qual"),
    )
    return rows.select(layouts.bin_rows_to_fastq().alias("record"))


@CATALOG.query(
    "molecule_bed_file",
    """SELECT o_orderpriority AS chrom, o_orderkey AS start, o_orderkey + o_custkey AS "end" FROM orders""",
)
def molecule_bed_file(spark, sf_dir):
    """Molecules written as BED in chromosome order and read again as intervals."""
    placed = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Chromosome"), F.col("o_orderkey").alias("StartPosition"),
        (F.col("o_orderkey") + F.col("o_custkey")).alias("EndPosition"), F.expr("o_orderkey div 3 + 1").alias("MoleculeID"),
        F.lit("x").alias("Barcode"), F.lit(4).alias("Reads"), F.col("o_custkey").alias("Length"), F.lit(2).alias("BpCovered"),
    )
    folder = new_folder(spark)
    sinks.write_bed(sinks.molecule_bed(placed), folder)
    return genomics.parse_bed(spark.read.text(folder).withColumnRenamed("value", "line"))


@CATALOG.query(
    "curves_parse",
    """SELECT 's' || CAST(o_custkey % 5 AS VARCHAR) AS stat, CAST(o_orderkey % 101 AS INTEGER) AS x, CAST(o_custkey AS DOUBLE) AS y FROM orders""",
)
def curves_parse(spark, sf_dir):
    """Contiguity curve text between comments."""
    line = F.concat_ws(
        "\t", F.concat(F.lit("s"), (F.col("o_custkey") % 5).cast("string")), (F.col("o_orderkey") % 101).cast("string"), F.col("o_custkey").cast("string")
    )
    text = table(spark, sf_dir, "orders").select(F.lit("f").alias("path"), F.explode(F.array(F.lit("# stat"), line, F.lit(" "))).alias("line"))
    return reports.parse_curves(text).drop("path")


@CATALOG.query(
    "genome_phasing",
    """WITH s AS (SELECT o_orderstatus AS sample, CASE WHEN o_orderstatus = 'P' THEN 'chr1' ELSE o_orderpriority END AS chromosome, count(*) AS het,
        count(*) FILTER (o_custkey % 5 <> 0) AS phased FROM orders GROUP BY ALL),
    r AS (SELECT * FROM s UNION ALL SELECT sample, 'ALL', sum(het), sum(phased) FROM s WHERE sample <> 'P' GROUP BY sample)
    SELECT sample, chromosome, round(100.0::DOUBLE * phased / het, 6) AS percent_snvs_phased,
           round(100.0::DOUBLE * phased / (2 * het), 6) AS percent_variants_phased
    FROM r WHERE chromosome = 'ALL' OR sample = 'P'""",
)
def genome_phasing(spark, sf_dir):
    """The row of the whole genome of each sample, or its only row."""
    chromosome = F.when(F.col("o_orderstatus") == "P", "chr1").otherwise(F.col("o_orderpriority"))
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("sample"), chromosome.alias("chromosome"))
        .agg(F.count(F.lit(1)).alias("heterozygous_snvs"), F.count_if(F.col("o_custkey") % 5 != 0).alias("phased_snvs"))
    )
    whole = rows.where("sample <> 'P'").groupBy("sample").agg(
        F.sum("heterozygous_snvs").alias("heterozygous_snvs"), F.sum("phased_snvs").alias("phased_snvs")
    )
    stats = rows.unionByName(whole.withColumn("chromosome", F.lit("ALL"))).withColumns(
        {"phased": F.col("phased_snvs"), "heterozygous_variants": 2 * F.col("heterozygous_snvs")}
    )
    shown = reports.genome_rows(stats)
    return shown.select("sample", "chromosome", *[F.round(c, 6).alias(c) for c in ("percent_snvs_phased", "percent_variants_phased")])


@CATALOG.query(
    "sv_totals",
    f"""WITH t AS ({INTERVALS.sql["sv_sizes_pivot"]}) SELECT "Size" AS "Size", CAST("DEL" + "INV" + "DUP" AS BIGINT) AS "Total" FROM t
    UNION ALL SELECT 'all', CAST(sum("DEL" + "INV" + "DUP") AS BIGINT) FROM t""",
)
def sv_totals(spark, sf_dir):
    """Structural variants by size over all types, and altogether."""
    sizes = INTERVALS.queries["sv_sizes_pivot"](spark, sf_dir)
    every = structural.total_calls(sizes).select(F.lit("all").alias("Size"), F.col("svs").alias("Total"))
    return structural.size_totals(sizes).unionByName(every)


@CATALOG.query(
    "report_text",
    """SELECT 'NK' || chr(9) || CAST(n_nationkey AS VARCHAR) || chr(9) || n_name AS line FROM nation
    UNION ALL SELECT rpad(n_name, 40, ' ') || ' ' || lpad(format('{:,}', n_nationkey * 1234), 15, ' ') FROM nation""",
)
def report_text(spark, sf_dir):
    """Statistics as sectioned lines, and counters as aligned text."""
    nations = table(spark, sf_dir, "nation")
    lines = sinks.stats_lines(nations.select("n_nationkey", "n_name"), "NK")
    counters = nations.select(F.col("n_name").alias("parameter"), (F.col("n_nationkey") * 1234).alias("value"))
    return lines.unionByName(sinks.summary_lines(counters))


def spelled_reads(spark, sf_dir):
    """Events as alignment text, parsed."""
    e = F.col("event_id")
    bases = F.concat(F.repeat(F.lit("G"), (e % 7).cast("int")), F.repeat(F.lit("a"), (e % 5).cast("int")), F.lit("N"))
    line = F.concat_ws(
        "\t", F.concat(F.lit("e"), e.cast("string")), F.when(e % 3 == 0, "1027").otherwise("67"), F.col("event_type"), (e + 1).cast("string"),
        F.lit("60"), F.lit("4M"), F.lit("="), F.lit("7"), (e % 40 - 5).cast("string"), bases, F.lit("F"),
    )
    return genomics.parse_sam(table(spark, sf_dir, "events").select(line.alias("line")))


@CATALOG.query(
    "insert_sizes",
    "SELECT event_id % 40 - 5 AS insert_size, count(*) AS n FROM events WHERE event_id % 3 <> 0 AND event_id % 40 > 5 GROUP BY 1",
)
def insert_sizes(spark, sf_dir):
    """Insert sizes of proper pairs that are no duplicates."""
    return statistics.insert_sizes(spelled_reads(spark, sf_dir))


@CATALOG.query(
    "gc_content",
    """SELECT CAST(floor(100 * (event_id % 7) / (event_id % 7 + event_id % 5)) AS BIGINT) AS gc, count(*) AS n FROM events
    WHERE event_id % 7 + event_id % 5 > 0 GROUP BY 1""",
)
def gc_content(spark, sf_dir):
    """Reads by share of G and C."""
    return statistics.gc_content(spelled_reads(spark, sf_dir))


@CATALOG.query("longest_per_sample", "SELECT event_type AS path, max(user_id) AS longest FROM events GROUP BY 1")
def longest_per_sample(spark, sf_dir):
    """The largest value of each sample."""
    return statistics.longest(table(spark, sf_dir, "events").select(F.col("event_type").alias("path"), "user_id"), "user_id")


@CATALOG.query(
    "phasing_stats_file",
    """SELECT o_orderstatus AS sample, o_orderpriority AS chromosome, count(*) AS heterozygous_snvs,
      count(*) FILTER (o_custkey % 5 <> 0) AS phased_snvs FROM orders GROUP BY ALL""",
)
def phasing_stats_file(spark, sf_dir):
    """Phasing statistics written as a table and read again."""
    stats = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("#sample"), F.col("o_orderpriority").alias("chromosome"))
        .agg(F.count(F.lit(1)).alias("heterozygous_snvs"), F.count_if(F.col("o_custkey") % 5 != 0).alias("phased_snvs"))
    )
    folder = new_folder(spark)
    sinks.write_tsv(stats, folder)
    return reports.read_phasing_stats(spark, folder)
