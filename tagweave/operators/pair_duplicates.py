"""Duplicates by the unclipped 5' ends of both mates.

A read's *end* is the place its first sequenced base would have without clipping, with chromosome, strand and barcode. Two mapped primary
records of a name are a pair, known by both ends in order; other mapped primary records are fragments.

* Of pairs with equal ends all but the best are duplicates: the highest sum of base qualities of at least ``GOOD_QUALITY``, then the smallest name.
* A fragment at an end that a pair has, too, is a duplicate; of fragments alone at an end all but the best are.
* Unmapped, secondary and supplementary records are never marked; earlier marks are taken away.

Best reads are partial minima by end, so places of great depth are no group of rows anywhere. Ends are moved once by name, and reads only to be flagged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.skew import lookup
from tagweave.operators.alleles import DUPLICATE, SECONDARY, SUPPLEMENTARY, UNMAPPED
from tagweave.operators.statistics import side_by_side
from tagweave.session import checkpointed

# Fixed value: bases of lower quality do not count for a read.
GOOD_QUALITY = 15
REVERSE = 16


def _clipped(pattern: str) -> Column:
    """Clipped bases at one end of the CIGAR."""
    ops = F.regexp_extract_all(F.regexp_extract("cigar", pattern, 1), F.lit(r"(\d+)"), F.lit(1))
    return F.aggregate(ops, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def unclipped_end() -> Column:
    """Place of the first sequenced base: before leading clips of forward reads, behind trailing clips of reverse ones."""
    forward = F.col("start") - _clipped(r"^((?:\d+[SH])+)")
    reverse = F.col("end") - 1 + _clipped(r"((?:\d+[SH])+)$")
    return F.when(F.col("flag").bitwiseAND(REVERSE) == 0, forward).otherwise(reverse)


def quality_sum(least: int = GOOD_QUALITY) -> Column:
    """Sum of the base qualities (ASCII) that are good enough; 0 for reads without qualities."""
    worth = np.arange(256, dtype=np.int64) - 33
    worth[worth < least] = 0

    @F.arrow_udf(T.LongType())
    def summed(quality: pa.Array) -> pa.Array:
        octets = quality.cast(pa.binary())
        sizes = pc.binary_length(octets).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        # Running sums over the qualities of a batch, read off where reads end.
        upto = np.concatenate(([0], np.cumsum(worth[np.frombuffer(b"".join(octets.to_pylist()), dtype=np.uint8)])))
        return pa.array(upto[ends[1:]] - upto[ends[:-1]])

    marks = F.coalesce("quality", F.lit(""))
    return summed(F.when(marks == "*", F.lit("")).otherwise(marks))


def _examined() -> Column:
    return (F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0) & F.col("rname").isNotNull() & F.col("start").isNotNull()


def _ends(reads: DataFrame, barcode: str | None) -> DataFrame:
    """``reads`` with ``_end``: place, strand, chromosome and barcode as one short text (the length of the chromosome's name parts both)."""
    code = F.coalesce(F.col(barcode), F.lit("")) if barcode else F.lit("")
    strand = F.when(F.col("flag").bitwiseAND(REVERSE) == 0, F.lit("+")).otherwise(F.lit("-"))
    end = F.concat(unclipped_end().cast("string"), strand, F.length("rname").cast("string"), F.lit(":"), F.col("rname"), code)
    return reads.withColumn("_end", F.when(_examined(), end))


def _units(rows: DataFrame) -> DataFrame:
    """(qname, low, high, score): a row per pair, by both ends, and one per record of other names, whose ``high`` is NULL.

    Rows are moved once, by name, and read in order; of a name that may go on two rows are held at most.
    """
    placed = rows.where("qname IS NOT NULL").select("qname", "_end", "score").repartition("qname").sortWithinPartitions("qname", "_end")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of the last name, and whether it has had more than two.
        kept, crowded = [pa.array([], kind) for kind in (pa.string(), pa.string(), pa.int64())], None
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = [pa.concat_arrays([k, c]) for k, c in zip(kept, batch.columns)]
            names = pc.dictionary_encode(joined[0]).indices.to_numpy(zero_copy_only=False)
            name = np.concatenate(([0], np.cumsum(names[1:] != names[:-1])))
            counts = np.bincount(name)
            if crowded is not None and joined[0][0].as_py() == crowded:
                counts[0] += 2
            # Records of the last name are told once it has more than two.
            last = int(name[-1])
            crowded = joined[0][len(name) - 1].as_py() if counts[last] > 2 else None
            done = len(name) if crowded is not None else int(np.searchsorted(name, last))
            kept = [c.slice(done) for c in joined]
            yield told([c.slice(0, done) for c in joined], counts[name[:done]])
        yield told(kept, np.full(len(kept[0]), len(kept[0])))

    def told(rows: list[pa.Array], counts: np.ndarray) -> pa.RecordBatch:
        """Units of whole names, or of records of crowded ones; ``counts`` has the size of each row's name."""
        pair = np.flatnonzero(counts == 2)
        first, second = pair[::2], pair[1::2]
        score = rows[2].to_numpy(zero_copy_only=False).copy()
        score[first] += score[second]
        high = np.full(len(counts), -1)
        high[first] = second
        chosen = np.flatnonzero((counts != 2) | (high >= 0))
        at, other = pa.array(chosen), pa.array(high[chosen], mask=high[chosen] < 0)
        return pa.RecordBatch.from_arrays([rows[0].take(at), rows[1].take(at), rows[1].take(other), pa.array(score[chosen])], names=["qname", "low", "high", "score"])

    return placed.mapInArrow(work, "qname string, low string, high string, score long")


def mark_pair_duplicates(reads: DataFrame, barcode: str | None = "bx") -> DataFrame:
    """``reads`` with bit 1024 of ``flag`` set for duplicates and unset for all others; ``barcode`` None compares across barcodes."""
    placed = _ends(reads, barcode)
    units = checkpointed(_units(placed.where("_end IS NOT NULL").select("qname", "_end", quality_sum().alias("score"))))
    rank = F.struct((-F.col("score")).alias("order"), "qname")
    pairs, single = units.where("high IS NOT NULL"), units.where("high IS NULL").select("qname", F.col("low").alias("_end"), "score")
    best = pairs.groupBy("low", "high").agg(F.min(rank).alias("best")).select("low", "high", F.col("best.qname").alias("_keep"))
    both = F.explode(F.array_distinct(F.array("low", "high"))).alias("_end")
    beaten = lookup(pairs.select("qname", "low", "high"), best, ["low", "high"]).where("qname <> _keep").select("qname", both)
    # What is known of an end: the best fragment there, and whether a pair has it.
    at_end = single.select("_end", rank.alias("rank"), F.lit(False).alias("paired")).unionByName(
        pairs.select(both, F.lit(None).cast(single.select(rank.alias("rank")).schema["rank"].dataType).alias("rank"), F.lit(True).alias("paired"))
    )
    ends = at_end.groupBy("_end").agg(F.min("rank").alias("best"), F.max("paired").alias("_paired")).select("_end", F.col("best.qname").alias("_keep"), "_paired")
    lost = lookup(single.select("qname", "_end"), ends, "_end").where("_paired OR qname <> _keep").select("qname", "_end")
    # One row each: pairs by both ends, fragments by theirs.
    marks = beaten.unionByName(lost.distinct()).withColumn("_again", F.lit(True))
    told = lookup(placed, marks, ["qname", "_end"])
    bare = F.col("flag").bitwiseAND(~DUPLICATE)
    flag = F.when(F.col("_again"), bare.bitwiseOR(DUPLICATE)).otherwise(bare)
    return told.withColumn("flag", flag.cast(reads.schema["flag"].dataType)).select(*reads.columns)


def duplication_metrics(marked: DataFrame) -> DataFrame:
    """One row: fragments and pairs examined, those that are duplicates, other records, and the share of reads that are duplicates."""
    examined = _examined()
    flagged = F.col("flag").bitwiseAND(DUPLICATE) != 0
    names = marked.where(examined).groupBy("qname").agg(F.count(F.lit(1)).alias("n"), F.count_if(flagged).alias("again"))
    pair = F.col("n") == 2
    counted = names.agg(
        F.coalesce(F.sum(F.when(~pair, F.col("n"))), F.lit(0)).alias("fragments"),
        F.count_if(pair).alias("pairs"),
        F.coalesce(F.sum(F.when(~pair, F.col("again"))), F.lit(0)).alias("fragment_duplicates"),
        F.count_if(pair & (F.col("again") > 0)).alias("pair_duplicates"),
    )
    share = (F.col("fragment_duplicates") + 2 * F.col("pair_duplicates")) / (F.col("fragments") + 2 * F.col("pairs"))
    others = marked.agg(F.count_if(~examined).alias("others"))
    rows = F.col("fragments") + F.col("pairs")
    return side_by_side(counted, others).withColumn("duplication", F.when(rows > 0, share).otherwise(F.lit(0.0)))
