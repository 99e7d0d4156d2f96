"""Molecule building: gap sessions of barcoded reads, with or without overlap rules.

Reads carry ``rname, start, end, bx, qname``. A read joins the current molecule of its
(chromosome, barcode) when it starts within ``window`` of the molecule's end; libraries made by
transposition also refuse reads that overlap the molecule by anything but the duplicated target
site. A refused read is dropped: it neither extends the molecule nor opens a new one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.orderstats import exact_quantiles, n50_inclusive
from tagweave.functions.scans import BUCKET, dense_ids
from tagweave.functions.skew import lookup
from tagweave.operators.statistics import side_by_side
from tagweave.session import checkpointed

# Tolerated overlap (bp) between neighbouring reads of one molecule, by library.
TOLERATED_OVERLAP = {
    "dbs": (8, 10),
    "stlfr": (8, 10),
    "tellseq": (4, 6),
    "10x": None,
}
DEFAULT_WINDOW = 30000
DEFAULT_MIN_READS = 4
NO_MOLECULE = -1

# Positions per scan bucket; far above a molecule's extent, so most keys need one bucket.
SCAN_WIDTH = 1 << 21
# Windows at least this wide leave few enough sessions of a key to scan them together.
WIDE_WINDOW = 2048


def analyzable(min_mapq: int = 0, barcode: str = "bx") -> Column:
    """Mapped, not a duplicate, confident enough and barcoded."""
    flag = F.col("flag")
    return (
        (flag.bitwiseAND(1024) == 0)
        & (flag.bitwiseAND(4) == 0)
        & (F.col("mapq") >= min_mapq)
        & F.col(barcode).isNotNull()
        & (F.col(barcode) != "")
    )


def _local_sessions(reads: DataFrame, keys: list[str], window: int | None) -> DataFrame:
    """(keys, bucket, start) -> ``local_start``, the first position of its session in that bucket.

    Reads are cut at bucket borders, so coverage adds up over buckets and no bucket needs to know
    how far reads of the one before reach. Pieces sharing a start always share a session and are
    collapsed before the shuffle by bucket: a (keys, bucket) group holds at most one row a position.
    """
    width = F.lit(SCAN_WIDTH)
    first, last = F.floor(F.col("start") / width), F.floor(F.greatest(F.col("start"), F.col("end") - 1) / width)
    pieces = reads.select(*keys, "start", "end", first.alias("_first"), F.explode(F.sequence(first, last)).alias(BUCKET))
    positions = (
        pieces.select(
            *keys,
            BUCKET,
            F.greatest("start", F.col(BUCKET) * width).alias("start"),
            F.least("end", (F.col(BUCKET) + 1) * width).alias("end"),
            (F.col(BUCKET) == F.col("_first")).cast("long").alias("reads"),
        )
        .groupBy(*keys, BUCKET, "start")
        .agg(F.max("end").alias("end"), F.sum("reads").alias("reads"))
    )
    within = Window.partitionBy(*keys, BUCKET).orderBy("start")
    prior = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    opens = _opens(F.col("_prior"), window)
    return (
        positions.withColumn("_prior", prior)
        .withColumn("covered", F.greatest(F.col("end") - F.greatest("start", "_prior"), F.lit(0)))
        .withColumn("local_start", F.max(F.when(opens, F.col("start"))).over(within))
        .drop("_prior")
    )


def _opens(prior: Column, window: int | None) -> Column:
    return prior.isNull() if window is None else prior.isNull() | (prior + F.lit(window) < F.col("start"))


def _joined_sessions(local: DataFrame, keys: list[str], window: int | None) -> DataFrame:
    """Bucket-local sessions with the ``mol_start`` they belong to.

    Sessions of a key are more than ``window`` apart but for bucket borders, so with a wide window
    they are at most range / window + range / bucket width, whatever the number of reads, and one
    window runs over them. With a narrow one only bucket summaries are scanned: nothing reaches over
    a bucket's begin, so just its first session can continue what came before.
    """
    partial = local.groupBy(*keys, BUCKET, F.col("local_start").alias("start")).agg(
        F.max("end").alias("end"), F.sum("reads").alias("reads"), F.sum("covered").alias("covered")
    )
    if window is not None and window < WIDE_WINDOW:
        return _linked_sessions(checkpointed(partial), keys, window)
    across = Window.partitionBy(*keys).orderBy("start")
    prior = F.max("end").over(across.rowsBetween(Window.unboundedPreceding, -1))
    return partial.withColumn("_prior", prior).withColumn(
        "mol_start", F.max(F.when(_opens(F.col("_prior"), window), F.col("start"))).over(across)
    )


def _linked_sessions(partial: DataFrame, keys: list[str], window: int) -> DataFrame:
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    buckets = partial.groupBy(*keys, BUCKET).agg(
        F.min("start").alias("start"), F.max("start").alias("_last"), F.max("end").alias("end")
    )
    opens = _opens(F.col("_prior"), window)
    # Start of the molecule a bucket ends with, where it is known without looking further back.
    ending = F.when(F.col("_last") > F.col("start"), F.col("_last")).when(opens, F.col("start"))
    links = (
        buckets.withColumn("_prior", F.max("end").over(before))
        .withColumn("_ending", ending)
        .withColumn("_mol", F.max("_ending").over(before))
        .where(~opens)
        .select(*keys, BUCKET, "start", "_mol")
    )
    return partial.join(links, [*keys, BUCKET, "start"], "left").withColumn("mol_start", F.coalesce("_mol", "start"))


def permissive_sessions(reads: DataFrame, keys: Sequence[str], window: int | None) -> DataFrame:
    """Session pieces (``end, reads, covered, mol_start``) when every overlap is acceptable."""
    return _joined_sessions(_local_sessions(reads, list(keys), window), list(keys), window)


def permissive_placements(reads: DataFrame, keys: Sequence[str], window: int | None) -> DataFrame:
    """(keys, start) -> ``mol_start`` when every overlap is acceptable."""
    keys = list(keys)
    # Read twice: for its sessions and for the places themselves.
    local = checkpointed(_local_sessions(reads, keys, window).select(*keys, BUCKET, "start", "end", "reads", "covered", "local_start"))
    joined = _joined_sessions(local, keys, window).select(*keys, BUCKET, F.col("start").alias("local_start"), "mol_start")
    starts = local.where(F.col("reads") > 0).select(*keys, BUCKET, "start", "local_start")
    return starts.join(joined, [*keys, BUCKET, "local_start"]).select(*keys, "start", "mol_start")


def _make_fold(keys: list[str], window: int | None, band: tuple[int, int]):
    """The walk over sorted rows, as a closure: executors need no copy of this package."""
    low, high = band

    def fold(rows: pd.DataFrame, state: dict | None) -> dict:
        """Walk the rows once; fills ``mol_start`` (None when refused) and ``covered``."""
        starts, ends = rows["start"].to_numpy().tolist(), rows["end"].to_numpy().tolist()
        names, prior = rows["qname"].tolist(), rows["prior"].to_numpy().tolist()
        idents = list(zip(*[rows[k].tolist() for k in keys]))
        state = state or {"key": None, "mol": None, "stop": None, "names": set(), "entry": None}
        placed, covered = [], []
        for ident, start, end, name, seen_before in zip(idents, starts, ends, names, prior):
            inside = ident == state["key"] and (window is None or state["stop"] + window >= start)
            if not inside:
                state = {"key": ident, "mol": start, "stop": end, "names": {name}, "entry": None}
                placed.append(start)
                covered.append(end - start)
                continue
            stop = state["stop"]
            sibling = name in state["names"] or (seen_before and state["mol"] == state["entry"])
            if sibling or stop < start or low <= stop - start <= high:
                covered.append(max(end - max(start, stop), 0))
                state["stop"] = max(stop, end)
                state["names"].add(name)
                placed.append(state["mol"])
            else:
                placed.append(None)
                covered.append(0)
        rows["mol_start"] = pd.array(placed, dtype="Int64")
        rows["covered"] = covered
        return state

    return fold


def strict_placements(
    reads: DataFrame,
    keys: Sequence[str],
    window: int | None,
    band: tuple[int, int],
    partitions: int | None = None,
) -> DataFrame:
    """(keys, start, end, qname) -> ``mol_start`` or NULL when the overlap rule refuses the read.

    Acceptance depends on the molecule's running end, so this is a true fold. Rows are range
    partitioned on the full sort key, which balances them whatever the key distribution, and every
    partition is folded at once from an empty state. A partition that begins inside a key is then
    folded again from the state its predecessor ended in (and told which of its names the running
    molecule already holds) until no such state changes, which gives the sequential result exactly. States of all partitions are
    composed before a round, so the number of rounds follows how far a running end reaches, not how many partitions a key has.
    """
    keys = list(keys)
    order = [*keys, "start", "end", "qname"]
    spark = reads.sparkSession
    distinct = reads.groupBy(*order).agg(F.count(F.lit(1)).alias("reads"))
    # Without a number, small neighbouring ranges are merged at run time; the order is kept.
    ranged = distinct.repartitionByRange(partitions, *order) if partitions else distinct.repartitionByRange(*order)
    chunks = checkpointed(
        ranged.sortWithinPartitions(*order)
        .withColumn("chunk", F.spark_partition_id())
        .withColumn("prior", F.lit(False))
    )
    fields = {f.name: f.dataType.simpleString() for f in chunks.schema.fields}
    columns = [*order, "reads", "chunk"]
    schema = ", ".join(f"`{c}` {fields[c]}" for c in columns) + ", mol_start bigint, covered bigint"
    out_columns = [*columns, "mol_start", "covered"]
    fold = _make_fold(keys, window, band)

    def fold_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for rows in batches:
            state = fold(rows, state)
            yield rows[out_columns]

    first_pass = checkpointed(chunks.mapInPandas(fold_partition, schema))

    # One row per partition: its first key and start, and its last key.
    borders = first_pass.groupBy("chunk").agg(F.min(F.struct(*keys, "start")).alias("lo"), F.max(F.struct(*keys)).alias("hi")).collect()
    edges = {r["chunk"]: (tuple(r["lo"])[:-1], tuple(r["hi"])) for r in borders}
    opening = {r["chunk"]: r["lo"]["start"] for r in borders}
    present = sorted(edges)
    continued = [c for before, c in zip(present, present[1:]) if edges[before][1] == edges[c][0]]
    if not continued:
        return first_pass.drop("chunk")
    lasting = set(continued)

    key_fields = ", ".join(f"`{k}` {fields[k]}" for k in keys)
    lead = spark.createDataFrame([(c, *edges[c][0]) for c in continued], f"chunk int, {key_fields}")
    tail = spark.createDataFrame([(c, *edges[c][1]) for c in present], f"chunk int, {key_fields}")
    lead_rows = chunks.drop("prior").join(F.broadcast(lead), ["chunk", *keys], "left_semi")
    settled = first_pass.join(F.broadcast(lead), ["chunk", *keys], "left_anti")
    refolded = first_pass.join(F.broadcast(lead), ["chunk", *keys], "left_semi")
    # The states that ``refolded`` was folded from; none in the first pass.
    entries: dict[int, tuple] = {}
    signature = None

    def composed(exits: dict[int, tuple]) -> dict[int, tuple]:
        """States to enter the continued partitions with, all of them in one walk over one row per partition.

        A partition of one key that is still in the molecule it entered hands that molecule on, whatever its start is.
        """
        found: dict[int, tuple] = {}
        for before, c in zip(present, present[1:]):
            left, entered = exits.get(before), found.get(before)
            if entered and edges[before][0] == edges[before][1]:
                joins = window is None or entered[1] + window >= opening[before]
                carried = entries[before][0] if before in entries else opening[before] if joins else None
                if left is None:
                    left = entered
                elif left[0] == carried:
                    left = (entered[0], max(left[1], entered[1]))
            if c in lasting and left:
                found[c] = left
        return found

    while True:
        current = settled.unionByName(refolded)
        ends = (
            current.where(F.col("mol_start").isNotNull())
            .join(F.broadcast(tail), ["chunk", *keys], "left_semi")
            .groupBy("chunk", "mol_start")
            .agg(F.max("end").alias("stop"))
            .groupBy("chunk")
            .agg(F.max(F.struct("mol_start", "stop")).alias("last"))
            .collect()
        )
        marks = (
            refolded.groupBy("chunk").agg(F.sum(F.xxhash64("start", "end", "qname", "mol_start").cast("decimal(38,0)")).alias("h")).collect()
        )
        exits = {r["chunk"]: (r["last"]["mol_start"], r["last"]["stop"]) for r in ends}
        entries = composed(exits)
        now = (sorted(entries.items()), sorted((r["chunk"], r["h"]) for r in marks))
        if now == signature:
            return current.drop("chunk")
        signature = now
        entry_rows = [(c, *edges[c][0], mol, stop) for c, (mol, stop) in entries.items()]
        entry = spark.createDataFrame(entry_rows, f"chunk int, {key_fields}, entry_mol bigint, entry_stop bigint")
        holders = (
            current.join(
                F.broadcast(entry.select(*keys, F.col("entry_mol").alias("mol_start")).distinct()),
                [*keys, "mol_start"],
                "left_semi",
            )
            .groupBy(*keys, F.col("mol_start").alias("entry_mol"), "qname")
            .agg(F.min("chunk").alias("first_chunk"))
        )
        rows = (
            lead_rows.join(F.broadcast(entry), ["chunk", *keys], "left")
            .join(holders, [*keys, "entry_mol", "qname"], "left")
            .withColumn("prior", F.coalesce(F.col("first_chunk") < F.col("chunk"), F.lit(False)))
        )

        def fold_lead(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(order, kind="stable", ignore_index=True)
            state = None
            if not pd.isna(rows["entry_mol"].iloc[0]):
                ident = tuple(rows[k].tolist()[0] for k in keys)
                mol, stop = int(rows["entry_mol"].iloc[0]), int(rows["entry_stop"].iloc[0])
                state = {"key": ident, "mol": mol, "stop": stop, "names": set(), "entry": mol}
            fold(rows, state)
            return rows[out_columns]

        refolded = checkpointed(rows.groupBy("chunk").applyInPandas(fold_lead, schema))


def place_reads(
    reads: DataFrame,
    library_type: str = "dbs",
    window: int | None = DEFAULT_WINDOW,
    keys: Sequence[str] = ("rname", "bx"),
) -> DataFrame:
    """Reads (already analyzable) with the start of their molecule, ``mol_start``; NULL if refused."""
    keys = list(keys)
    band = TOLERATED_OVERLAP[library_type]
    if band is None:
        on = [*keys, "start"]
        return lookup(reads, checkpointed(permissive_placements(reads, keys, window)), on)
    on = [*keys, "start", "end", "qname"]
    return lookup(reads, strict_placements(reads, keys, window, band).select(*on, "mol_start"), on)


def build_molecules(
    reads: DataFrame,
    library_type: str = "dbs",
    window: int | None = DEFAULT_WINDOW,
    min_reads: int = DEFAULT_MIN_READS,
    min_mapq: int = 0,
    keys: Sequence[str] = ("rname", "bx"),
) -> DataFrame:
    """Molecules with at least ``min_reads`` reads, one row each, named by (keys, StartPosition)."""
    keys = list(keys)
    usable = reads.where(analyzable(min_mapq))
    band = TOLERATED_OVERLAP[library_type]
    if band is None:
        placed = permissive_sessions(usable, keys, window)
    else:
        placed = strict_placements(usable, keys, window, band).where(F.col("mol_start").isNotNull())
    return (
        placed.groupBy(*keys, "mol_start")
        .agg(F.sum("reads").alias("Reads"), F.max("end").alias("EndPosition"), F.sum("covered").alias("BpCovered"))
        .where(F.col("Reads") >= min_reads)
        .select(
            *[F.col(k) for k in keys],
            F.col("mol_start").alias("StartPosition"),
            "EndPosition",
            "Reads",
            (F.col("EndPosition") - F.col("mol_start")).alias("Length"),
            "BpCovered",
        )
    )


def read_molecules(
    reads: DataFrame, library_type: str = "dbs", min_reads: int = DEFAULT_MIN_READS, min_mapq: int = 0
) -> DataFrame:
    """Molecules of reads that already carry a molecule number ``mi``: grouped by (rname, bx, mi)."""
    tagged = reads.where(F.col("mi").isNotNull() & (F.col("mi") != 0) & (F.col("mi") != NO_MOLECULE))
    return build_molecules(tagged, library_type, None, min_reads, min_mapq, keys=("rname", "bx", "mi"))


def molecule_table(molecules: DataFrame) -> DataFrame:
    """The five-column molecule statistics table (plus coordinates) with dense ``MoleculeID``."""
    return dense_ids(molecules, ["rname", "bx", "StartPosition"], "MoleculeID").select(
        "MoleculeID",
        F.col("bx").alias("Barcode"),
        "Reads",
        "Length",
        "BpCovered",
        F.col("rname").alias("Chromosome"),
        "StartPosition",
        "EndPosition",
    )


def _name_tags(reads: DataFrame, library_type: str, window: int, min_reads: int, min_mapq: int) -> DataFrame:
    """(qname, last): the last kept molecule of each name by (chromosome, end, start, barcode)."""
    placed = place_reads(reads.where(analyzable(min_mapq)), library_type, window).where(F.col("mol_start").isNotNull())
    per_name = placed.groupBy("rname", "bx", "mol_start", "qname").agg(
        F.count(F.lit(1)).alias("n"), F.max("end").alias("end")
    )
    kept = (
        per_name.groupBy("rname", "bx", "mol_start")
        .agg(F.sum("n").alias("n"), F.max("end").alias("mol_end"))
        .where(F.col("n") >= min_reads)
    )
    return (
        per_name.drop("n", "end")
        .join(kept.drop("n"), ["rname", "bx", "mol_start"])
        .groupBy("qname")
        .agg(F.max(F.struct("rname", "mol_end", "mol_start", "bx")).alias("last"))
    )


def tag_reads(
    reads: DataFrame,
    library_type: str = "dbs",
    window: int = DEFAULT_WINDOW,
    min_reads: int = DEFAULT_MIN_READS,
    min_mapq: int = 0,
) -> DataFrame:
    """All reads with the molecule of their *name*: ``mi`` is its start, -1 when there is none.

    A name met in several molecules takes the last one by (chromosome, end, start, barcode). Reads
    left out of molecule building (duplicates, unmapped) still receive the tag of their name.
    """
    last = _name_tags(reads, library_type, window, min_reads, min_mapq)
    tags = last.select("qname", F.col("last.mol_start").alias("mi"))
    return reads.drop("mi").join(tags, "qname", "left").withColumn("mi", F.coalesce("mi", F.lit(NO_MOLECULE)))


def number_reads(
    reads: DataFrame,
    table: DataFrame,
    library_type: str = "dbs",
    window: int = DEFAULT_WINDOW,
    min_reads: int = DEFAULT_MIN_READS,
    min_mapq: int = 0,
) -> DataFrame:
    """Like :func:`tag_reads`, with ``mi`` the ``MoleculeID`` of a molecule table."""
    last = _name_tags(reads, library_type, window, min_reads, min_mapq).select(
        "qname",
        F.col("last.rname").alias("Chromosome"),
        F.col("last.bx").alias("Barcode"),
        F.col("last.mol_start").alias("StartPosition"),
    )
    on = ["Chromosome", "Barcode", "StartPosition"]
    tags = last.join(table.select(*on, F.col("MoleculeID").alias("mi")), on).select("qname", "mi")
    return reads.drop("mi").join(tags, "qname", "left").withColumn("mi", F.coalesce("mi", F.lit(NO_MOLECULE)))


def crowded_barcodes(molecules: DataFrame, max_molecules: int, barcode: str = "bx") -> DataFrame:
    """Barcodes with more than ``max_molecules`` molecules; none when the limit is 0."""
    counts = molecules.groupBy(barcode).agg(F.count(F.lit(1)).alias("molecules"))
    return counts.where((F.col("molecules") > max_molecules) & F.lit(max_molecules > 0)).select(barcode)


def without_barcodes(molecules: DataFrame, barcodes: DataFrame, barcode: str = "bx") -> DataFrame:
    """Anti join of molecules (or reads) against a barcode list."""
    listed = barcodes.select(barcode).distinct().withColumn("_listed", F.lit(True))
    return lookup(molecules, listed, barcode).where(F.col("_listed").isNull()).drop("_listed")


def molecule_summary(molecules: DataFrame) -> DataFrame:
    """One row: fragment N50, mean / median / longest length, mean / median read coverage in percent."""
    coverage = F.try_divide(F.lit(100.0) * F.col("BpCovered"), F.col("Length"))
    rated = checkpointed(molecules.select("Length", coverage.alias("coverage")))
    main = rated.agg(
        F.count(F.lit(1)).alias("molecules"),
        F.avg("Length").alias("mean_length"),
        F.max("Length").alias("longest"),
        F.avg("coverage").alias("mean_coverage"),
    )
    return side_by_side(
        main,
        n50_inclusive(rated, "Length").withColumnRenamed("n50", "n50_length"),
        exact_quantiles(rated, "Length", {"median_length": 0.5}),
        exact_quantiles(rated, "coverage", {"median_coverage": 0.5}, width=0.01),
    )
