"""Order statistics, histograms and summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.molecule_queries import MIN_MAPQ, MIN_READS, PERMISSIVE, WINDOW
from tagweave.catalog.views import EVENT_READS, event_reads, table
from tagweave.functions import histograms as hist
from tagweave.functions import orderstats
from tagweave.operators import molecules as mol
from tagweave.operators import statistics as st

CATALOG = Catalog()


def _molecules(spark, sf_dir):
    built = mol.build_molecules(event_reads(spark, sf_dir), "10x", WINDOW, MIN_READS, MIN_MAPQ)
    return built.withColumnRenamed("bx", "Barcode")


def _price_spans(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("chrom"), F.floor("o_totalprice").alias("span")
    )


def _clusters(spark, sf_dir):
    """One cluster per customer: orders = reads, distinct priorities = components."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("canonical"))
        .agg(F.count(F.lit(1)).alias("size"), F.collect_set("o_orderpriority").alias("components"))
    )


SPANS = "spans AS (SELECT o_orderpriority AS chrom, CAST(floor(o_totalprice) AS BIGINT) AS span FROM orders)"
CLUSTERS = """clusters AS (SELECT CAST(o_custkey AS VARCHAR) AS canonical, count(*) AS size,
  count(DISTINCT o_orderpriority) AS comps FROM orders GROUP BY o_custkey)"""


@CATALOG.query(
    "n50_inclusive",
    f"""WITH {SPANS},
    c AS (SELECT chrom, span, sum(span) OVER (PARTITION BY chrom ORDER BY span DESC) AS cs,
                 sum(span) OVER (PARTITION BY chrom) AS total FROM spans)
    SELECT chrom, max(span) AS n50 FROM c WHERE cs >= floor(total / 2) GROUP BY chrom""",
)
def n50_inclusive(spark, sf_dir):
    """Inclusive N50 per chromosome."""
    return orderstats.n50_inclusive(_price_spans(spark, sf_dir), "span", ["chrom"], width=4096)


@CATALOG.query(
    "nx_strict",
    f"""WITH {SPANS},
    c AS (SELECT chrom, span, sum(span) OVER (PARTITION BY chrom ORDER BY span DESC) AS cs,
                 sum(span) OVER (PARTITION BY chrom) AS total FROM spans)
    SELECT chrom, max(span) AS nx FROM c WHERE cs * 100 > total * 50 GROUP BY chrom""",
)
def nx_strict(spark, sf_dir):
    """Strict N50 per chromosome."""
    return orderstats.nx(_price_spans(spark, sf_dir), "span", 50, ["chrom"], width=4096)


@CATALOG.query(
    "nx_curve",
    f"""WITH {SPANS},
    g AS (SELECT chrom, span, sum(span) AS w FROM spans GROUP BY chrom, span),
    c AS (SELECT chrom, span, sum(w) OVER (PARTITION BY chrom ORDER BY span DESC) AS cs,
                 sum(w) OVER (PARTITION BY chrom) AS total FROM g),
    x AS (SELECT UNNEST(range(0, 101)) AS x),
    k AS (SELECT DISTINCT chrom FROM g)
    SELECT k.chrom, CAST(x.x AS INTEGER) AS x,
           CAST(coalesce((SELECT max(span) FROM c WHERE c.chrom = k.chrom AND cs * 100 > total * x.x), 0) AS BIGINT) AS y
    FROM k CROSS JOIN x""",
)
def nx_curve(spark, sf_dir):
    """Contiguity curve, x = 0..100, per chromosome."""
    return orderstats.nx_curve(_price_spans(spark, sf_dir), "span", ["chrom"], width=4096)


@CATALOG.query(
    "ngx_curve",
    f"""WITH {SPANS},
    g AS (SELECT span, sum(span) AS w FROM spans GROUP BY span),
    c AS (SELECT span, sum(w) OVER (ORDER BY span DESC) AS cs FROM g),
    x AS (SELECT UNNEST(range(0, 101)) AS x)
    SELECT CAST(x.x AS INTEGER) AS x,
           CAST(coalesce((SELECT max(span) FROM c WHERE cs * 100 > 1500000000 * x.x), 0) AS BIGINT) AS y
    FROM x""",
)
def ngx_curve(spark, sf_dir):
    """Curve against an external genome length."""
    return orderstats.nx_curve(_price_spans(spark, sf_dir), "span", total=F.lit(1_500_000_000), width=4096)


@CATALOG.query(
    "anx_weighted",
    """WITH l AS (SELECT l_returnflag AS chrom, CAST(floor(l_extendedprice) AS BIGINT) AS span,
                         CAST(l_quantity AS BIGINT) AS n FROM lineitem),
    g AS (SELECT chrom, span, sum(n) AS w FROM l GROUP BY chrom, span),
    c AS (SELECT chrom, span, sum(w) OVER (PARTITION BY chrom ORDER BY span DESC) AS cs,
                 sum(w) OVER (PARTITION BY chrom) AS total FROM g)
    SELECT chrom, max(span) AS nx FROM c WHERE cs * 100 > total * 50 GROUP BY chrom""",
)
def anx_weighted(spark, sf_dir):
    """AN50: spans ranked, counts accumulated."""
    spans = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("chrom"),
        F.floor("l_extendedprice").alias("span"),
        F.col("l_quantity").cast("long").alias("n"),
    )
    return orderstats.nx(spans, "span", 50, ["chrom"], weight="n", width=4096)


@CATALOG.query(
    "aun",
    f"""WITH {SPANS}
    SELECT chrom, round(CAST(sum(CAST(span AS HUGEINT) * span) AS DOUBLE) / sum(span), 6) AS aun,
           round(CAST(sum(CAST(span AS HUGEINT) * span) AS DOUBLE) / 1500000000, 6) AS aung
    FROM spans GROUP BY chrom""",
)
def aun(spark, sf_dir):
    """Area under the Nx and NGx curves."""
    return (
        _price_spans(spark, sf_dir)
        .groupBy("chrom")
        .agg(
            F.round(orderstats.area_under_nx("span"), 6).alias("aun"),
            F.round(orderstats.area_under_nx("span", F.lit(1_500_000_000)), 6).alias("aung"),
        )
    )


@CATALOG.query(
    "span_quantiles",
    f"""WITH {SPANS}
    SELECT chrom, round(quantile_cont(CAST(span AS DOUBLE), 0.5), 6) AS median,
           round(quantile_cont(CAST(span AS DOUBLE), 0.99), 6) AS q99 FROM spans GROUP BY chrom""",
)
def span_quantiles(spark, sf_dir):
    """Exact interpolated quantiles per chromosome."""
    got = orderstats.exact_quantiles(
        _price_spans(spark, sf_dir), "span", {"median": 0.5, "q99": 0.99}, ["chrom"], width=4096
    )
    return got.select("chrom", F.round("median", 6).alias("median"), F.round("q99", 6).alias("q99"))


@CATALOG.query(
    "weighted_mean_share",
    """WITH l AS (SELECT l_returnflag AS chrom, CAST(floor(l_extendedprice) AS BIGINT) AS len FROM lineitem)
    SELECT chrom, round(100.0::DOUBLE * sum(CASE WHEN len > 20000 THEN len ELSE 0 END) / sum(len), 6) AS over_20k,
           round(CAST(sum(CAST(len AS HUGEINT) * len) AS DOUBLE) / sum(len), 6) AS weighted_mean
    FROM l GROUP BY chrom""",
)
def weighted_mean_share(spark, sf_dir):
    """Length-weighted mean and share of bases in long molecules."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("chrom"), F.floor("l_extendedprice").alias("len")
    )
    long = F.sum(F.when(F.col("len") > 20000, F.col("len")).otherwise(0))
    return rows.groupBy("chrom").agg(
        F.round(F.lit(100.0) * long / F.sum("len"), 6).alias("over_20k"),
        F.round(orderstats.area_under_nx("len"), 6).alias("weighted_mean"),
    )


MOL_STATS = f"""WITH {EVENT_READS}, {PERMISSIVE},
    r AS (SELECT Reads, sum(Reads) OVER (ORDER BY Reads DESC) AS cs, sum(Reads) OVER () AS total FROM molecules),
    b AS (SELECT bx, count(*) AS n, sum(Length) AS dna FROM molecules GROUP BY bx)
    SELECT round(avg(Reads), 6) AS mean_reads_per_molecule, round(avg(Length), 6) AS mean_molecule_length,
      round(100.0::DOUBLE * sum(CASE WHEN Length > 20000 THEN Length ELSE 0 END) / sum(Length), 6) AS dna_over_20_kbp_percent,
      round(100.0::DOUBLE * sum(CASE WHEN Length > 100000 THEN Length ELSE 0 END) / sum(Length), 6) AS dna_over_100_kbp_percent,
      round(CAST(sum(CAST(Length AS HUGEINT) * Length) AS DOUBLE) / sum(Length), 6) AS weighted_mean_length,
      CAST(count(DISTINCT bx) AS BIGINT) AS barcodes_final,
      (SELECT round(avg(n), 6) FROM b) AS mean_molecule_count,
      (SELECT round(100.0::DOUBLE * avg(CASE WHEN n = 1 THEN 1 ELSE 0 END), 6) FROM b) AS single_molecule_droplets_percent,
      (SELECT round(avg(dna), 6) FROM b) AS mean_dna_per_barcode,
      (SELECT CAST(max(Reads) AS BIGINT) FROM r WHERE cs >= floor(total / 2)) AS n50_reads_per_molecule,
      round(quantile_cont(CAST(Reads AS DOUBLE), 0.5), 6) AS median_reads_per_molecule,
      round(quantile_cont(CAST(Length AS DOUBLE), 0.5), 6) AS median_molecule_length,
      (SELECT round(quantile_cont(CAST(n AS DOUBLE), 0.5), 6) FROM b) AS median_molecule_count,
      (SELECT round(quantile_cont(CAST(dna AS DOUBLE), 0.5), 6) FROM b) AS median_dna_per_barcode
    FROM molecules"""


@CATALOG.query("molecule_statistics", MOL_STATS)
def molecule_statistics(spark, sf_dir):
    """Fourteen molecule summary numbers."""
    stats = st.molecule_statistics(_molecules(spark, sf_dir))
    whole = {"barcodes_final", "n50_reads_per_molecule"}
    return stats.select(*[F.col(c) if c in whole else F.round(c, 6).alias(c) for c in stats.columns])


@CATALOG.query(
    "molecule_count_of_counts",
    f"""WITH {EVENT_READS}, {PERMISSIVE},
    b AS (SELECT bx, count(*) AS n FROM molecules GROUP BY bx)
    SELECT n AS "Molecules", count(*) AS "Count" FROM b GROUP BY n""",
)
def molecule_count_of_counts(spark, sf_dir):
    """Barcodes by number of molecules."""
    return st.molecules_per_barcode(_molecules(spark, sf_dir))


@CATALOG.query(
    "molecule_length_hist",
    f"""WITH {EVENT_READS}, {PERMISSIVE}
    SELECT CAST((ceil(Length / 1000.0) - 1) * 1000 AS BIGINT) AS "Bin", CAST(sum(Length) AS BIGINT) AS "LengthSum"
    FROM molecules WHERE Length > 0 GROUP BY 1""",
)
def molecule_length_hist(spark, sf_dir):
    """Bases per 1 kbp length bin."""
    return hist.weighted_length_histogram(_molecules(spark, sf_dir), "Length")


@CATALOG.query(
    "coverage_hist",
    f"""WITH {EVENT_READS}, {PERMISSIVE},
    p AS (SELECT CAST((BpCovered * 100 + Length - 1) // Length - 1 AS INTEGER) AS "Percent"
          FROM molecules WHERE BpCovered > 0 AND BpCovered <= Length)
    SELECT "Percent", count(*) AS "Count" FROM p GROUP BY 1""",
)
def coverage_hist(spark, sf_dir):
    """Molecules per percent covered."""
    return hist.coverage_histogram(_molecules(spark, sf_dir), "BpCovered", "Length")


@CATALOG.query(
    "reads_per_bc_hist",
    """WITH c AS (SELECT user_id, count(*) AS reads FROM events GROUP BY user_id)
    SELECT CAST(reads // 2 * 2 AS BIGINT) AS "Bin", count(*) AS "Count" FROM c
    WHERE NOT (reads % 2 = 0 AND reads = (SELECT max(reads) FROM c)) GROUP BY 1""",
)
def reads_per_bc_hist(spark, sf_dir):
    """Barcodes per reads bin of width 2, with the original even-maximum edge."""
    reads = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("reads"))
    return hist.count_histogram(reads, "reads", 2, drop_even_maximum=True)


@CATALOG.query(
    "barcode_summary",
    f"""WITH {CLUSTERS}
    SELECT CAST(sum(comps) AS BIGINT) AS barcodes_raw, count(*) AS barcodes_corrected,
           count(*) FILTER (size > 3) AS barcodes_corrected_over_3, max(size) AS maximum_reads_per_barcode,
           round(avg(size), 6) AS mean_reads_per_barcode,
           round(quantile_cont(CAST(size AS DOUBLE), 0.5), 6) AS median_reads_per_barcode FROM clusters""",
)
def barcode_summary(spark, sf_dir):
    """Six summary numbers of the cluster table."""
    got = st.cluster_summary(_clusters(spark, sf_dir))
    rounded = {"mean_reads_per_barcode", "median_reads_per_barcode"}
    return got.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in got.columns])


@CATALOG.query(
    "barcode_stats_rb",
    f"""WITH {CLUSTERS}
    SELECT size AS reads, count(*) AS barcodes, CAST(size * count(*) AS BIGINT) AS total,
           round(CAST(size * count(*) AS DOUBLE) / (SELECT sum(size) FROM clusters), 6) AS density
    FROM clusters GROUP BY size""",
)
def barcode_stats_rb(spark, sf_dir):
    """Reads per barcode table."""
    return st.reads_per_barcode(_clusters(spark, sf_dir)).withColumn("density", F.round("density", 6))


@CATALOG.query(
    "barcode_stats_cb",
    f"WITH {CLUSTERS} SELECT CAST(comps AS INTEGER) AS components, count(*) AS barcodes FROM clusters GROUP BY comps",
)
def barcode_stats_cb(spark, sf_dir):
    """Clusters by number of components."""
    return st.components_per_barcode(_clusters(spark, sf_dir))


@CATALOG.query(
    "percent_of_total",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n,
       round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS percent
    FROM orders GROUP BY o_orderpriority, o_orderstatus""",
)
def percent_of_total(spark, sf_dir):
    """Share of each status within its priority."""
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return st.percent_of_total(counts, "n", "percent", ["o_orderpriority"]).withColumn("percent", F.round("percent", 6))


@CATALOG.query(
    "geom_hist_weighted",
    """WITH s AS (SELECT o_orderstatus AS chrom, CAST(floor(o_totalprice) AS BIGINT) AS len FROM orders),
    m AS (SELECT max(len) AS top FROM s),
    e AS (SELECT i, CAST(floor((CASE i WHEN 0 THEN 10000.0 WHEN 99 THEN top + 10000.0
            ELSE pow(10, 4 + i * (log10(top + 10000) - 4) / 99) END) / 10000) * 10000 AS BIGINT) AS edge
          FROM m, (SELECT UNNEST(range(0, 100)) AS i)),
    edges AS (SELECT DISTINCT edge FROM e),
    binned AS (SELECT chrom, (SELECT max(edge) FROM edges WHERE edge <= len) AS edge, len FROM s WHERE len >= 10000),
    sums AS (SELECT chrom, edge, sum(len) AS w FROM binned GROUP BY chrom, edge),
    tot AS (SELECT chrom, sum(w) AS total FROM sums GROUP BY chrom)
    SELECT t.chrom, CAST(l.edge // 1000 AS INTEGER) AS kbp,
           round(coalesce(CAST(s.w AS DOUBLE) / t.total, 0), 6) AS density
    FROM tot t CROSS JOIN (SELECT DISTINCT edge FROM e WHERE i < 99) l
    LEFT JOIN sums s ON s.chrom = t.chrom AND s.edge = l.edge""",
)
def geom_hist_weighted(spark, sf_dir):
    """Length-weighted histogram over geometric bins."""
    spans = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("chrom"), F.floor("o_totalprice").alias("len")
    )
    return hist.geometric_length_histogram(spans, "len", ["chrom"])


@CATALOG.query(
    "tail_cut",
    """WITH g AS (SELECT o_orderstatus AS chrom, CAST(floor(o_totalprice / 1000) AS BIGINT) AS x, count(*) AS y
                  FROM orders GROUP BY 1, 2),
    c AS (SELECT chrom, x, sum(y) OVER (PARTITION BY chrom ORDER BY x) AS cs, sum(y) OVER (PARTITION BY chrom) AS t FROM g)
    SELECT chrom, min(x) AS xmax FROM c WHERE cs > t * 0.99::DOUBLE GROUP BY chrom""",
)
def tail_cut(spark, sf_dir):
    """Where the long tail of a distribution is cut."""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("chrom"), F.floor(F.col("o_totalprice") / 1000).alias("x"))
        .agg(F.count(F.lit(1)).alias("y"))
    )
    return st.tail_position(counts, "x", "y", 0.99, ["chrom"])


@CATALOG.query(
    "bin_sums",
    """WITH s AS (SELECT CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders),
    e AS (SELECT UNNEST(range(0, (SELECT max(v) // 2000 * 2000 + 1 FROM s), 2000)) AS b)
    SELECT e.b AS "Bin", round(CAST(coalesce(sum(s.v), 0) AS DOUBLE) / (SELECT sum(v) FROM s), 9) AS "Weight"
    FROM e LEFT JOIN s ON s.v // 2000 * 2000 = e.b GROUP BY e.b""",
)
def bin_sums(spark, sf_dir):
    """Normalised sums over fixed-width bins, empty ones included."""
    values = table(spark, sf_dir, "orders").select(F.floor("o_totalprice").alias("v"))
    return hist.bin_sums(values, "v", 2000, normalize=True).withColumn("Weight", F.round("Weight", 9))


@CATALOG.query(
    "unit_scaling",
    """WITH m AS (SELECT o_orderpriority AS sample, CAST(sum(floor(o_totalprice)) AS BIGINT) AS longest
                  FROM orders GROUP BY 1), t AS (SELECT max(longest) AS top FROM m)
    SELECT sample, longest, round(longest * CASE WHEN top > 1000000 THEN 0.000001::DOUBLE ELSE 0.001 END, 6) AS shown,
           CASE WHEN top > 1000000 THEN 'M' ELSE 'k' END AS shown_unit FROM m, t""",
)
def unit_scaling(spark, sf_dir):
    """Report values scaled to M or k by the overall maximum."""
    totals = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("sample"))
        .agg(F.sum(F.floor("o_totalprice")).alias("longest"))
    )
    return st.scaled(totals, "longest", "shown").withColumn("shown", F.round("shown", 6))


@CATALOG.query(
    "tag_value_counts",
    f"""WITH {EVENT_READS}, v AS (SELECT DISTINCT CAST(p_size + 20 AS VARCHAR) AS value FROM part)
    SELECT v.value, count(r.event_id) AS "count" FROM v LEFT JOIN reads r ON CAST(r.mapq AS VARCHAR) = v.value
    GROUP BY v.value""",
)
def tag_value_counts(spark, sf_dir):
    """Reads per requested tag value, zeros included."""
    values = table(spark, sf_dir, "part").select((F.col("p_size") + 20).cast("string").alias("value"))
    return st.value_counts(event_reads(spark, sf_dir), "mapq", values)


@CATALOG.query(
    "reads_with_tag_values",
    f"""WITH {EVENT_READS} SELECT event_id, bx FROM reads
    WHERE bx IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0)""",
)
def reads_with_tag_values(spark, sf_dir):
    """Reads whose barcode is in a list."""
    values = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("value"))
    return st.rows_with_values(event_reads(spark, sf_dir), "bx", values).select("event_id", "bx")


@CATALOG.query(
    "read_counters",
    f"""WITH {EVENT_READS}, w AS (SELECT count(*) AS total,
      count(*) FILTER (flag & 4 <> 0) AS unmapped, count(*) FILTER (flag & 1024 <> 0) AS duplicates,
      count(*) FILTER (bx IS NULL) AS untagged, count(*) FILTER (mapq < {MIN_MAPQ}) AS low_mapq FROM reads)
    UNPIVOT w ON total, unmapped, duplicates, untagged, low_mapq INTO NAME parameter VALUE value""",
)
def read_counters(spark, sf_dir):
    """Tool counters from one pass."""
    return st.counters(
        event_reads(spark, sf_dir),
        {
            "total": F.lit(True),
            "unmapped": F.col("flag").bitwiseAND(4) != 0,
            "duplicates": F.col("flag").bitwiseAND(1024) != 0,
            "untagged": F.col("bx").isNull(),
            "low_mapq": F.col("mapq") < MIN_MAPQ,
        },
    )


@CATALOG.query(
    "chrom_rank_sort",
    """WITH n AS (SELECT 'chr' || CASE c_nationkey WHEN 0 THEN 'X' WHEN 1 THEN 'Y' WHEN 2 THEN 'M' WHEN 3 THEN 'Un'
                   WHEN 4 THEN 'Alt' ELSE CAST(c_nationkey AS VARCHAR) END AS chrom, count(*) AS n
                 FROM customer GROUP BY 1),
    k AS (SELECT *, replace(chrom, 'chr', '') AS b FROM n),
    r AS (SELECT *, CASE WHEN regexp_full_match(b, '[0-9]+') THEN CAST(b AS INTEGER) WHEN b = 'X' THEN 23
                         WHEN b = 'Y' THEN 24 WHEN b = 'M' THEN 25 END AS num FROM k)
    SELECT chrom, n, CAST(CASE WHEN num IS NULL THEN 1 ELSE 0 END AS INTEGER) AS grp,
           CAST(coalesce(num, 0) AS INTEGER) AS num, CASE WHEN num IS NULL THEN b ELSE '' END AS name FROM r""",
)
def chrom_rank_sort(spark, sf_dir):
    """Chromosomes with their sort key, in order."""
    key = F.col("c_nationkey")
    special = F.create_map(*[F.lit(v) for pair in zip(range(5), ["X", "Y", "M", "Un", "Alt"]) for v in pair])
    name = F.concat(F.lit("chr"), F.coalesce(F.try_element_at(special, key), key.cast("string")))
    counts = table(spark, sf_dir, "customer").groupBy(name.alias("chrom")).agg(F.count(F.lit(1)).alias("n"))
    rank = st.chromosome_rank(F.col("chrom"))
    return counts.orderBy(rank).select(
        "chrom", "n", rank["group"].alias("grp"), rank["number"].alias("num"), rank["name"].alias("name")
    )
