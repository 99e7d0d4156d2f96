"""Read, position and variant views derived from the given tables (Spark and matching SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str):
    """Epoch seconds of a timestamp without time zone (session time zone is UTC)."""
    return F.unix_seconds(F.col(column).cast("timestamp"))


def event_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as alignments: user = barcode, type = chromosome, second = start, value = length."""
    return reads_of(table(spark, sf_dir, "events"))


def reads_of(events: DataFrame) -> DataFrame:
    """A batch or stream of events as alignments."""
    start = seconds("ts")
    return events.select(
        "event_id",
        F.concat(F.lit("r"), (F.col("event_id") % 7).cast("string")).alias("qname"),
        F.concat(F.lit("p"), F.floor(F.col("event_id") / 2).cast("string")).alias("pair"),
        (F.when(F.col("event_id") % 13 == 0, 1024).otherwise(0) + F.when(F.col("event_id") % 29 == 0, 4).otherwise(0))
        .cast("int")
        .alias("flag"),
        F.col("event_type").alias("rname"),
        start.alias("start"),
        (start + F.round(F.col("value") * 100).cast("long")).alias("end"),
        (F.col("event_id") % 61).cast("int").alias("mapq"),
        F.when(F.col("event_id") % 31 != 0, F.col("user_id").cast("string")).alias("bx"),
    )


# The same view for the reference SQL.
EVENT_READS = """
reads AS (
  SELECT event_id,
         'r' || CAST(event_id % 7 AS VARCHAR) AS qname,
         'p' || CAST(event_id // 2 AS VARCHAR) AS pair,
         (CASE WHEN event_id % 13 = 0 THEN 1024 ELSE 0 END)
           + (CASE WHEN event_id % 29 = 0 THEN 4 ELSE 0 END) AS flag,
         event_type AS rname,
         epoch_us(ts) // 1000000 AS start,
         epoch_us(ts) // 1000000 + CAST(round(value * 100) AS BIGINT) AS "end",
         event_id % 61 AS mapq,
         CASE WHEN event_id % 31 <> 0 THEN CAST(user_id AS VARCHAR) END AS bx
  FROM events)
"""

ANALYZABLE = "flag & 1024 = 0 AND flag & 4 = 0 AND mapq >= {min_mapq} AND bx IS NOT NULL"
