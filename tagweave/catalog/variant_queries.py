"""Variant filtering, phase block and haplotype accuracy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.catalog.views import table
from tagweave.operators import phasing as ph
from tagweave.operators import variants as va

CATALOG = Catalog()
SOFT = "qual < 50,lowQUAL; mqranksum > 6.0,highMQRankSum; af < 0.15 || af > 0.95,oddAF"


def order_variants(spark, sf_dir, truth: bool = False):
    """Orders as variant records: priority = chromosome, order key = position."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def base(offset):
        return F.substring(F.lit("ACGT"), ((k + offset) % 4 + 1).cast("int"), F.lit(1))

    if truth:
        bit = (F.expr("o_orderkey div 230") + (k % 23 == 0).cast("int") + (c % 11 == 0).cast("int")) % 2
        phased, ps, alt = c % 19 != 0, F.expr("o_orderkey div 900") * 900, F.when(k % 29 == 0, base(2)).otherwise(base(1))
    else:
        bit = F.expr("o_orderkey div 97") % 2
        phased, ps, alt = c % 17 != 0, F.expr("o_orderkey div 420") * 420, base(1)
    top = F.when(k % 31 == 0, 2).otherwise(1)
    gt = F.when(c % 13 == 0, F.array(F.lit(1), F.lit(1))).when(bit == 0, F.array(F.lit(0), top)).otherwise(F.array(top, F.lit(0)))
    alts = (
        F.when(k % 101 == 0, F.array(alt, base(2), base(3)))
        .when(k % 31 == 0, F.array(alt, base(3)))
        .when(k % 37 == 0, F.array(F.lit("AC")))
        .otherwise(F.array(alt))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("chrom"),
        k.alias("pos"),
        base(0).alias("ref"),
        alts.alias("alts"),
        gt.alias("gt"),
        phased.alias("phased"),
        F.when(k % 211 != 0, ps).alias("ps"),
        (c % 200).cast("double").alias("qual"),
        F.when(k % 3 == 0, (k % 80) / 10.0).cast("double").alias("mqranksum"),
        ((k % 100) / 100.0).cast("double").alias("af"),
        F.when(k % 50 == 0, F.array(F.lit("shallow"))).otherwise(F.array(F.lit("PASS"))).alias("filter"),
    )


def _sql_view(name: str, truth: bool) -> str:
    def base(offset):
        return f"substr('ACGT', CAST((o_orderkey + {offset}) % 4 AS INTEGER) + 1, 1)"

    if truth:
        bit = "(o_orderkey // 230 + CAST(o_orderkey % 23 = 0 AS INT) + CAST(o_custkey % 11 = 0 AS INT)) % 2"
        phased, ps = "o_custkey % 19 <> 0", "o_orderkey // 900 * 900"
        alt = f"CASE WHEN o_orderkey % 29 = 0 THEN {base(2)} ELSE {base(1)} END"
    else:
        bit = "o_orderkey // 97 % 2"
        phased, ps, alt = "o_custkey % 17 <> 0", "o_orderkey // 420 * 420", base(1)
    top = "CASE WHEN o_orderkey % 31 = 0 THEN 2 ELSE 1 END"
    return f"""{name} AS (SELECT o_orderpriority AS chrom, o_orderkey AS pos, {base(0)} AS ref,
      CASE WHEN o_orderkey % 101 = 0 THEN [{alt}, {base(2)}, {base(3)}] WHEN o_orderkey % 31 = 0 THEN [{alt}, {base(3)}]
           WHEN o_orderkey % 37 = 0 THEN ['AC'] ELSE [{alt}] END AS alts,
      CASE WHEN o_custkey % 13 = 0 OR {bit} <> 0 THEN CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE {top} END ELSE 0 END AS g0,
      CASE WHEN o_custkey % 13 = 0 THEN 1 WHEN {bit} = 0 THEN {top} ELSE 0 END AS g1,
      {phased} AS phased, CASE WHEN o_orderkey % 211 <> 0 THEN {ps} END AS ps,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS idx
      FROM orders)"""


def _sql_blocks(name: str, source: str) -> str:
    return f"""{name}_p AS (SELECT chrom, coalesce(ps, -1) AS ps, idx, pos, g0, g1, [ref] || alts AS alleles FROM {source}
        WHERE phased AND g0 <> g1 AND len(alts) <= 2
          AND length(([ref] || alts)[g0 + 1]) = 1 AND length(([ref] || alts)[g1 + 1]) = 1),
    {name}_s AS (SELECT chrom, ps, count(*) AS n, count(*) OVER (PARTITION BY chrom) AS sets FROM {name}_p GROUP BY chrom, ps),
    {name} AS (SELECT p.* FROM {name}_p p JOIN {name}_s s USING (chrom, ps) WHERE s.n > 1 AND (ps <> -1 OR sets = 1))"""


BLOCKS = f"{_sql_view('v', False)}, {_sql_blocks('asm', 'v')}"
# The walk over each block pair, one variant after the other, for both alleles.
WALK = f"""{BLOCKS}, {_sql_view('t', True)}, {_sql_blocks('truth', 't')},
numbered AS (SELECT *, row_number() OVER (PARTITION BY chrom, ps ORDER BY idx) AS ord FROM asm),
common AS (
  SELECT a.chrom, r.ps AS ref_ps, a.ps, a.idx, a.pos, a.ord,
         (a.g0 = r.g0 AND a.g1 = r.g1 OR a.g0 = r.g1 AND a.g1 = r.g0) AND a.alleles = r.alleles AS usable,
         r.g0 <> a.g0 AS x0, r.g0 <> a.g1 AS x1,
         row_number() OVER w AS seq, lag(a.ord) OVER w AS pord, lag(r.g0 <> a.g0) OVER w AS px0, lag(r.g0 <> a.g1) OVER w AS px1
  FROM numbered a JOIN truth r ON r.chrom = a.chrom AND r.pos = a.pos
  WINDOW w AS (PARTITION BY a.chrom, r.ps, a.ps ORDER BY a.idx)),
firsts AS (SELECT chrom, ref_ps, ps, min(seq) FILTER (usable) AS f, max(seq) AS n FROM common GROUP BY ALL HAVING f IS NOT NULL),
opening AS (
  SELECT c.chrom, c.ref_ps, c.ps,
    (coalesce(min(seq) FILTER (seq > f AND (ord - pord > 1 OR x0 = px0)), max(n) + 1) - max(f) - 1) % 2 = 1 AS odd0,
    (coalesce(min(seq) FILTER (seq > f AND (ord - pord > 1 OR x1 = px1)), max(n) + 1) - max(f) - 1) % 2 = 1 AS odd1
  FROM common c JOIN firsts USING (chrom, ref_ps, ps) GROUP BY ALL),
u AS (SELECT chrom, ref_ps, ps, idx, pos, x0, x1, row_number() OVER w AS rn, count(*) OVER (PARTITION BY chrom, ref_ps, ps) AS n
      FROM common WHERE usable WINDOW w AS (PARTITION BY chrom, ref_ps, ps ORDER BY idx)),
ua AS (SELECT u.chrom, u.ref_ps, u.ps, u.rn, u.n, a.a, CASE a.a WHEN 0 THEN x0 ELSE x1 END AS x,
              CASE a.a WHEN 0 THEN odd0 ELSE odd1 END AS odd
       FROM u JOIN opening USING (chrom, ref_ps, ps), (VALUES (0), (1)) a(a)),
walk AS (
  SELECT chrom, ref_ps, ps, a, rn, n, x AS switched, odd AS after_switch, CAST([] AS BIGINT[]) AS sl, CAST([] AS BIGINT[]) AS ml
  FROM ua WHERE rn = 1
  UNION ALL
  SELECT w.chrom, w.ref_ps, w.ps, w.a, k.rn, w.n, k.x, k.x <> w.switched AND NOT w.after_switch,
    CASE WHEN k.x = w.switched THEN w.sl WHEN w.after_switch THEN w.sl[1:len(w.sl) - 1] ELSE list_append(w.sl, k.rn) END,
    CASE WHEN k.x <> w.switched AND w.after_switch THEN list_append(w.ml, k.rn) ELSE w.ml END
  FROM walk w JOIN ua k ON k.chrom = w.chrom AND k.ref_ps = w.ref_ps AND k.ps = w.ps AND k.a = w.a AND k.rn = w.rn + 1),
done AS (SELECT chrom, ref_ps, ps, a, n, CASE WHEN after_switch THEN sl[1:len(sl) - 1] ELSE sl END AS sl,
                CASE WHEN after_switch THEN list_append(ml, n) ELSE ml END AS ml FROM walk WHERE rn = n),
chosen AS (SELECT d0.chrom, d0.ref_ps, d0.ps, d0.n, CASE WHEN len(d0.sl) < len(d1.sl) THEN d0.sl ELSE d1.sl END AS sl,
                  CASE WHEN len(d0.sl) < len(d1.sl) THEN d0.ml ELSE d1.ml END AS ml
           FROM done d0 JOIN done d1 USING (chrom, ref_ps, ps) WHERE d0.a = 0 AND d1.a = 1),
flat AS (SELECT chrom, ref_ps, ps, least(count(*) FILTER (x0), count(*) FILTER (x1)) AS flat FROM u GROUP BY ALL),
pairs AS (SELECT chrom, ref_ps, ps, n AS comparable, len(sl) AS switches, len(ml) AS mismatches, flat
          FROM chosen JOIN flat USING (chrom, ref_ps, ps))"""

SEGMENTS = """ev AS (SELECT chrom, ref_ps, ps, n, UNNEST(sl) AS e, 's' AS kind FROM chosen
  UNION ALL SELECT chrom, ref_ps, ps, n, UNNEST(ml), 'm' FROM chosen
  UNION ALL SELECT chrom, ref_ps, ps, n, n + 1, 'end' FROM chosen),
cuts AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY chrom, ref_ps, ps ORDER BY e), 1) AS since FROM ev),
ranges AS (SELECT chrom, ref_ps, ps, since AS lo, CASE kind WHEN 'm' THEN e - 2 ELSE e - 1 END AS hi FROM cuts
           WHERE kind = 'm' AND e - since > 2 OR kind = 's' AND e - since > 1 OR kind = 'end' AND e - since > 1),
segments AS (SELECT r.chrom, r.ref_ps, r.ps, r.hi - r.lo + 1 AS variants, b.pos - a.pos AS span,
    CAST((b.pos - a.pos) AS DOUBLE) * ((r.hi - r.lo + 1) / (b.idx - a.idx + 1)) AS adjusted_span
  FROM ranges r JOIN u a ON a.chrom = r.chrom AND a.ref_ps = r.ref_ps AND a.ps = r.ps AND a.rn = r.lo
                JOIN u b ON b.chrom = r.chrom AND b.ref_ps = r.ref_ps AND b.ps = r.ps AND b.rn = r.hi)"""

SPANS = """blocks AS (SELECT chrom, ps, count(*) AS variants, arg_max(pos, idx) - arg_min(pos, idx) AS span,
    CAST(arg_max(pos, idx) - arg_min(pos, idx) AS DOUBLE) * (count(*) / (max(idx) - min(idx) + 1)) AS adjusted_span
    FROM asm GROUP BY chrom, ps)"""


@CATALOG.query(
    "phase_blocks", f"WITH {BLOCKS} SELECT chrom, ps, idx, pos, g0, g1, array_to_string(alleles, '/') AS alleles FROM asm"
)
def phase_blocks(spark, sf_dir):
    """Variants of blocks with two or more phased heterozygous sites."""
    rows = va.block_rows(order_variants(spark, sf_dir))
    return rows.withColumn("alleles", F.concat_ws("/", "alleles"))


@CATALOG.query(
    "block_spans",
    f"WITH {BLOCKS}, {SPANS} SELECT chrom, ps, variants, span, round(adjusted_span, 6) AS adjusted_span FROM blocks",
)
def block_spans(spark, sf_dir):
    """Span and adjusted span of every block."""
    spans = va.block_spans(va.block_rows(order_variants(spark, sf_dir)))
    return spans.withColumn("adjusted_span", F.round("adjusted_span", 6))


def _both(spark, sf_dir):
    return va.block_rows(order_variants(spark, sf_dir)), va.block_rows(order_variants(spark, sf_dir, truth=True))


@CATALOG.query("switch_errors", f"WITH RECURSIVE {WALK} SELECT * FROM pairs")
def switch_errors(spark, sf_dir):
    """Errors per pair of assembled and true block."""
    return ph.compare_phasings(*_both(spark, sf_dir))[0]


@CATALOG.query(
    "error_split_spans",
    f"""WITH RECURSIVE {WALK}, {SEGMENTS}
    SELECT chrom, ref_ps, ps, variants, span, round(adjusted_span, 6) AS adjusted_span FROM segments""",
)
def error_split_spans(spark, sf_dir):
    """Stretches of blocks between errors."""
    segments = ph.compare_phasings(*_both(spark, sf_dir))[1]
    return segments.withColumn("adjusted_span", F.round("adjusted_span", 6))


@CATALOG.query(
    "error_rollup",
    f"""WITH RECURSIVE {WALK},
    c AS (SELECT coalesce(chrom, 'All') AS chrom, CAST(sum(switches) AS BIGINT) AS switch_count,
      CAST(sum(CASE WHEN comparable >= 4 THEN comparable - 3 ELSE 0 END) AS BIGINT) AS switch_positions,
      CAST(sum(mismatches) AS BIGINT) AS mismatch_count,
      CAST(sum(CASE WHEN comparable >= 2 THEN comparable ELSE 0 END) AS BIGINT) AS mismatch_positions,
      CAST(sum(flat) AS BIGINT) AS flat_count FROM pairs GROUP BY ROLLUP (chrom))
    SELECT *, mismatch_positions AS flat_positions, round(switch_count / switch_positions, 9) AS switch_rate,
      round(mismatch_count / mismatch_positions, 9) AS mismatch_rate, round(flat_count / mismatch_positions, 9) AS flat_rate,
      round((switch_count + mismatch_count) / mismatch_positions, 9) AS switch_mismatch_rate FROM c""",
)
def error_rollup(spark, sf_dir):
    """Error counts and rates per chromosome and overall."""
    rates = ph.error_rates(ph.error_counts(ph.compare_phasings(*_both(spark, sf_dir))[0]))
    return rates.select(*[F.round(c, 9).alias(c) if c.endswith("rate") else F.col(c) for c in rates.columns])


def _nx_sql(source: str, value: str, weight: str, total: str) -> str:
    return f"""(SELECT max({value}) FROM (SELECT {value}, sum({weight}) OVER (ORDER BY {value} DESC) AS cs,
        sum({weight}) OVER () AS t FROM {source} s WHERE g.chrom = 'All' OR s.chrom = g.chrom) WHERE cs * 100 > 50 * {total})"""


def _aun_sql(source: str, total: str) -> str:
    return f"""(SELECT round(CAST(sum(CAST(span AS HUGEINT) * span) AS DOUBLE) / {total}, 6) FROM {source} s
        WHERE g.chrom = 'All' OR s.chrom = g.chrom)"""


@CATALOG.query(
    "haplotype_report",
    f"""WITH RECURSIVE {WALK}, {SEGMENTS}, {SPANS},
    g0 AS (SELECT coalesce(chrom, 'All') AS chrom, CAST(sum(switches) AS BIGINT) AS switch_count,
      CAST(sum(CASE WHEN comparable >= 2 THEN comparable ELSE 0 END) AS BIGINT) AS mp FROM pairs GROUP BY ROLLUP (chrom)),
    g AS (SELECT *, CASE WHEN chrom = 'All' THEN 100000 ELSE 20000 END AS genome FROM g0)
    SELECT chrom, switch_count, {_nx_sql('blocks', 'span', 'span', 't')} AS n50, {_nx_sql('segments', 'span', 'span', 't')} AS qn50,
      {_nx_sql('blocks', 'span', 'span', 'g.genome')} AS ng50, {_nx_sql('segments', 'span', 'span', 'g.genome')} AS qng50,
      round({_nx_sql('blocks', 'adjusted_span', 'variants', 'g.mp')}, 6) AS an50,
      round({_nx_sql('segments', 'adjusted_span', 'variants', 'g.mp')}, 6) AS qan50,
      {_aun_sql('blocks', 'sum(span)')} AS aun, {_aun_sql('segments', 'sum(span)')} AS auqn,
      {_aun_sql('blocks', 'g.genome')} AS aung, {_aun_sql('segments', 'g.genome')} AS auqng,
      (SELECT count(*) FROM asm s WHERE g.chrom = 'All' OR s.chrom = g.chrom) AS phased_count,
      (SELECT count(*) FROM truth s WHERE g.chrom = 'All' OR s.chrom = g.chrom) AS phased_count_ref,
      (SELECT CAST(sum(m) AS BIGINT) FROM (SELECT chrom, max(variants) AS m FROM blocks GROUP BY chrom) s
       WHERE g.chrom = 'All' OR s.chrom = g.chrom) AS num_snps_max_blk,
      (SELECT CAST(quantile_cont(CAST(span AS DOUBLE), 0.5) AS DOUBLE) FROM blocks s WHERE g.chrom = 'All' OR s.chrom = g.chrom) AS median_block_length,
      round(mp / (SELECT count(*) FROM asm s WHERE g.chrom = 'All' OR s.chrom = g.chrom), 9) AS phased_rate_asm,
      round(mp / (SELECT count(*) FROM truth s WHERE g.chrom = 'All' OR s.chrom = g.chrom), 9) AS phased_rate_ref
    FROM g""",
)
def haplotype_report(spark, sf_dir):
    """Every haplotype metric per chromosome and overall."""
    lengths = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("chrom")).distinct()
    report = ph.haplotype_report(*_both(spark, sf_dir), lengths.withColumn("length", F.lit(20000)))
    six = ["an50", "qan50", "aun", "auqn", "aung", "auqng"]
    nine = ["phased_rate_asm", "phased_rate_ref"]
    plain = ["chrom", "switch_count", "n50", "qn50", "ng50", "qng50", "phased_count", "phased_count_ref", "num_snps_max_blk"]
    plain.append("median_block_length")
    return report.select(*plain, *[F.round(c, 6).alias(c) for c in six], *[F.round(c, 9).alias(c) for c in nine])


@CATALOG.query(
    "contiguity_curves",
    f"""WITH RECURSIVE {WALK}, {SEGMENTS}, {SPANS}, x AS (SELECT UNNEST(range(0, 101)) AS x),
    r AS (SELECT 'NX' AS stat, CAST(span AS DOUBLE) AS v, sum(span) AS w FROM blocks GROUP BY 2
      UNION ALL SELECT 'QNX', CAST(span AS DOUBLE), sum(span) FROM segments GROUP BY 2
      UNION ALL SELECT 'ANX', adjusted_span, sum(variants) FROM blocks GROUP BY 2
      UNION ALL SELECT 'QAN', adjusted_span, sum(variants) FROM segments GROUP BY 2),
    c AS (SELECT stat, v, sum(w) OVER (PARTITION BY stat ORDER BY v DESC) AS cs, sum(w) OVER (PARTITION BY stat) AS t FROM r)
    SELECT s.stat, CAST(x.x AS INTEGER) AS x,
      round(coalesce((SELECT max(v) FROM c WHERE c.stat = s.stat AND cs * 100 > t * x.x), 0), 6) AS y
    FROM (SELECT DISTINCT stat FROM r) s CROSS JOIN x""",
)
def contiguity_curves(spark, sf_dir):
    """Contiguity curves of blocks and of error-split blocks."""
    asm, truth = _both(spark, sf_dir)
    segments = ph.compare_phasings(asm, truth)[1]
    return ph.contiguity_curves(va.block_spans(asm), segments).withColumn("y", F.round("y", 6))


@CATALOG.query(
    "soft_filters",
    """SELECT o_orderpriority AS chrom, o_orderkey AS pos,
      coalesce(nullif(concat_ws(';', CASE WHEN o_orderkey % 50 = 0 THEN 'shallow' END,
        CASE WHEN o_custkey % 200 < 50 THEN 'lowQUAL' END,
        CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 80 / 10.0 > 6.0 THEN 'highMQRankSum' END,
        CASE WHEN o_orderkey % 100 < 15 OR o_orderkey % 100 > 95 THEN 'oddAF' END), ''), 'PASS') AS filter
    FROM orders""",
)
def soft_filters(spark, sf_dir):
    """Failed conditions appended to FILTER."""
    filtered = va.apply_soft_filters(order_variants(spark, sf_dir), va.parse_soft_filters(SOFT))
    return filtered.select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@CATALOG.query(
    "phase_input",
    f"""WITH {_sql_view('v', False)}
    SELECT v.chrom, v.pos, g0, g1 FROM v JOIN orders o ON o.o_orderkey = v.pos
    WHERE g0 = 0 AND g1 IN (1, 2) AND o_orderkey % 50 <> 0 AND o_custkey % 200 >= 50
      AND NOT coalesce(o_orderkey % 3 = 0 AND o_orderkey % 80 / 10.0 > 6.0, FALSE)
      AND NOT (o_orderkey % 100 < 15 OR o_orderkey % 100 > 95)
      AND EXISTS (SELECT 1 FROM nation WHERE v.chrom <> '5-LOW' AND v.pos >= n_nationkey * 600 AND v.pos < n_nationkey * 600 + 400)""",
)
def phase_input(spark, sf_dir):
    """Passing heterozygous variants ready for phasing, inside the regions of all chromosomes but one."""
    start = F.col("n_nationkey") * 600
    chroms = F.array(*[F.lit(c) for c in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")])
    regions = table(spark, sf_dir, "nation").select(
        F.explode(chroms).alias("chrom"), start.cast("long").alias("start"), (start + 400).cast("long").alias("end")
    )
    rows = va.phase_input(va.apply_soft_filters(order_variants(spark, sf_dir), va.parse_soft_filters(SOFT)), regions)
    return rows.select("chrom", "pos", F.element_at("gt", 1).alias("g0"), F.element_at("gt", 2).alias("g1"))


@CATALOG.query(
    "variant_types",
    f"""WITH {_sql_view('v', False)} SELECT chrom, len(list_filter(alts, lambda a: length(a) <> 1)) = 0 AND length(ref) = 1 AS snv,
      count(*) AS n FROM v GROUP BY ALL""",
)
def variant_types(spark, sf_dir):
    """SNV and indel records per chromosome."""
    return order_variants(spark, sf_dir).groupBy("chrom", va.is_snv().alias("snv")).agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query(
    "phasing_statistics",
    f"""WITH {_sql_view('v', False)},
    m AS (SELECT chrom, pos, ps, phased, g0 <> g1 AND len(alts) <= 2 AS het,
                 g0 <> g1 AND len(alts) <= 2 AND len(list_filter(alts, lambda a: length(a) <> 1)) = 0 AS snv FROM v
          UNION ALL
          SELECT 'ALL', pos, ps, phased, g0 <> g1 AND len(alts) <= 2,
                 g0 <> g1 AND len(alts) <= 2 AND len(list_filter(alts, lambda a: length(a) <> 1)) = 0 FROM v),
    s0 AS (SELECT chrom, ps, count(*) AS n, count(*) FILTER (snv) AS snvs, max(pos) - min(pos) AS bp
          FROM (SELECT v.chrom, ps, pos, len(list_filter(alts, lambda a: length(a) <> 1)) = 0 AS snv FROM v
                WHERE phased AND g0 <> g1 AND len(alts) <= 2) GROUP BY chrom, ps),
    s AS (SELECT * FROM s0 UNION ALL SELECT 'ALL', ps, n, snvs, bp FROM s0),
    a AS (SELECT chrom, count(*) AS variants, count(*) FILTER (het) AS heterozygous_variants,
                 count(*) FILTER (snv) AS heterozygous_snvs FROM m GROUP BY chrom),
    b AS (SELECT chrom, count(*) FILTER (n = 1) AS singletons, CAST(sum(n) FILTER (n > 1) AS BIGINT) AS phased,
      CAST(sum(snvs) FILTER (n > 1) AS BIGINT) AS phased_snvs, count(*) FILTER (n > 1) AS blocks,
      round(avg(n) FILTER (n > 1), 6) AS variant_per_block_avg, min(n) FILTER (n > 1) AS variant_per_block_min,
      max(n) FILTER (n > 1) AS variant_per_block_max, round(avg(bp) FILTER (n > 1), 6) AS bp_per_block_avg,
      min(bp) FILTER (n > 1) AS bp_per_block_min, max(bp) FILTER (n > 1) AS bp_per_block_max,
      CAST(sum(bp) FILTER (n > 1) AS BIGINT) AS bp_per_block_sum,
      round(quantile_cont(CAST(n AS DOUBLE), 0.5) FILTER (n > 1), 6) AS variant_per_block_median,
      round(quantile_cont(CAST(bp AS DOUBLE), 0.5) FILTER (n > 1), 6) AS bp_per_block_median FROM s GROUP BY chrom)
    SELECT a.*, b.* EXCLUDE (chrom), a.heterozygous_variants - b.phased - b.singletons AS unphased FROM a JOIN b USING (chrom)""",
)
def phasing_statistics(spark, sf_dir):
    """Block statistics per chromosome and for ALL."""
    stats = va.phasing_statistics(order_variants(spark, sf_dir))
    return stats.select(*[F.round(c, 6).alias(c) if c.endswith(("_avg", "_median")) else F.col(c) for c in stats.columns])
