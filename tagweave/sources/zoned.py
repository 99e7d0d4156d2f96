"""Tables of intervals laid out by zones, so that a set of regions reads only the files that can hold their rows.

A *zone* is the smallest of a hierarchy of bins that holds an interval: 128 kb bins, then bins eight times as wide, up to 512 Mb. Rows are written
in order of chromosome and zone, and an index of the zones in every file is written beside them. Regions become the zones that may hold
rows overlapping them (a few on each level), which are joined to the index; the scan is given the files found, however far apart
the regions are, and zones bound the row groups within.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators.intervals import rows_in_regions
from tagweave.session import checkpointed

# Widths of bins as powers of two, narrow first; wider intervals share one zone of their chromosome.
LEVELS = (17, 20, 23, 26, 29)
ZONE = "zone"


def _first_of(level: int) -> int:
    """Number of the first bin of a level: coarser bins come first, as there are fewer of them."""
    return 1 + sum(1 << (40 - bits) for bits in LEVELS[level + 1 :])


def zone(start: Column, end: Column) -> Column:
    """The zone of a half-open interval of at least one base; NULL without a place."""
    last = F.greatest(start, end - 1)
    out = F.when(start.isNull() | end.isNull(), F.lit(None).cast("long"))
    for level, bits in enumerate(LEVELS):
        out = out.when(F.shiftright(start, bits) == F.shiftright(last, bits), F.shiftright(start, bits) + _first_of(level))
    return out.otherwise(F.lit(0).cast("long"))


def zones_of(regions: DataFrame, chrom: str = "chrom") -> DataFrame:
    """(chrom, zone): all zones that may hold rows overlapping a region."""
    last = F.greatest("start", F.col("end") - 1)

    def on_level(level: int, bits: int) -> Column:
        bins = F.sequence(F.shiftright("start", bits), F.shiftright(last, bits))
        return F.transform(bins, lambda k: k + _first_of(level))

    levels = [on_level(level, bits) for level, bits in enumerate(LEVELS)]
    everywhere = F.array(F.lit(0).cast("long"))
    return regions.select(chrom, F.explode(F.concat(everywhere, *levels)).alias(ZONE)).distinct()


def write_zoned(rows: DataFrame, folder: str, chrom: str = "chrom", files: int | None = None) -> None:
    """Write ``rows`` (with ``start`` and ``end``) by zones under ``folder``, and the index of zones."""
    placed = rows.withColumn(ZONE, zone(F.col("start").cast("long"), F.col("end").cast("long")))
    order = [chrom, ZONE, "start"]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(f"{folder}/rows")
    held = rows.sparkSession.read.parquet(f"{folder}/rows")
    index = held.where(F.col(ZONE).isNotNull()).groupBy(chrom, ZONE, F.col("_metadata.file_name").alias("file"))
    index.agg(F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/index")


def read_regions(spark: SparkSession, folder: str, regions: DataFrame, chrom: str = "chrom", width: int = 1 << 17) -> DataFrame:
    """Rows overlapping any region, each once, from the files that hold zones of the regions.

    The driver sees the names of these files, at most those that Spark lists for a scan of the whole table.
    """
    wanted = checkpointed(zones_of(regions, chrom))
    index = spark.read.parquet(f"{folder}/index")
    found = index.join(wanted, [chrom, ZONE], "left_semi")
    files = sorted(r.file for r in found.select("file").distinct().collect())
    schema = spark.read.parquet(f"{folder}/rows").schema
    if not files:
        return spark.createDataFrame([], schema).drop(ZONE)
    rows = spark.read.schema(schema).parquet(*[f"{folder}/rows/{name}" for name in files])
    # Within files, zones of other places are passed over before positions are compared.
    near = rows.join(wanted, [chrom, ZONE], "left_semi")
    return rows_in_regions(near, regions, width, chrom).drop(ZONE)
