"""Strict molecules over a stream: one stateful processor per (chromosome, barcode).

A read's acceptance depends on the running end of its molecule, so reads are folded in order of position. A micro-batch brings them in any
order and, within the watermark's delay, late: they wait in state until the watermark has passed them, are sorted, and then join, extend or open the
molecule of their key as in the batch operator. A timer at a waiting read's position folds it; a timer past ``end + window`` reports the
molecule and clears its state, so state holds open molecules and reads of the delay only.

Positions are event time: a read at place p is an event at second p. ``place`` is its start on one chromosome; streams over several
chromosomes in genome order need places that rise along the genome (``genome_place``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tagweave.functions.skew import lookup
from tagweave.operators.molecules import DEFAULT_WINDOW, TOLERATED_OVERLAP, analyzable
from tagweave.session import shared_folder

# The state store that timers and typed state need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING = "start bigint, stop bigint, qname string, place bigint"
OPEN = "mol_start bigint, stop bigint, n bigint, covered bigint, place bigint"


def genome_place(offsets: DataFrame, reads: DataFrame, contig: str = "rname") -> DataFrame:
    """``reads`` with ``place``: their start on all contigs laid end to end; ``offsets`` has (contig, offset), a row per contig."""
    return lookup(reads, offsets.select(contig, "offset"), contig).withColumn("place", F.col("start") + F.col("offset")).drop("offset")


class StrictMolecules(StatefulProcessor):
    """Folds the reads of a key in order of (start, end, name) behind the watermark."""

    def __init__(self, window: int, band: tuple[int, int] | None):
        self._window, self._band = window, band

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", PENDING)
        self._open = handle.getValueState("open", OPEN)
        self._names = handle.getMapState("names", "qname string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        soonest = None
        for batch in rows:
            places = batch["place"]
            waiting = list(zip(*[batch[c].tolist() for c in ("start", "end", "qname", "place")], strict=True))
            self._pending.appendList([(int(s), int(e), q, int(p)) for s, e, q, p in waiting])
            soonest = int(places.min()) if soonest is None else min(soonest, int(places.min()))
        if soonest is not None:
            self._handle.registerTimer(soonest * 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = list(self._pending.get()) if self._pending.exists() else []
        # Whatever may still arrive lies beyond the watermark.
        ready = sorted((tuple(r) for r in waiting if r[3] * 1000 <= passed), key=lambda r: (r[0], r[1], r[2]))
        later = [tuple(r) for r in waiting if r[3] * 1000 > passed]
        if waiting:
            self._keep(later)
        held = self._state()
        done, state, fresh = self._fold(ready, held)
        if state is not None:
            # A read exactly ``window`` away still belongs to the molecule.
            closing = (state[4] + state[1] - state[0] + self._window + 1) * 1000
            if closing <= passed:
                # What closes in the walk that opened it is never stored.
                done.append(state)
                if held is not None:
                    self._clear()
            else:
                self._store(state, fresh)
                self._handle.registerTimer(closing)
        if later:
            self._handle.registerTimer(min(r[3] for r in later) * 1000)
        if done:
            rows = [(*key, mol, stop, n, stop - mol, covered) for mol, stop, n, covered, _ in done]
            yield pd.DataFrame(rows, columns=["rname", "bx", "StartPosition", "EndPosition", "Reads", "Length", "BpCovered"])

    def close(self) -> None:
        pass

    def _keep(self, rows: list[tuple]) -> None:
        if rows:
            self._pending.put(rows)
        else:
            self._pending.clear()

    def _state(self) -> tuple | None:
        return tuple(self._open.get()) if self._open.exists() else None

    def _clear(self) -> None:
        self._open.clear()
        self._names.clear()

    def _store(self, state: tuple, fresh: set[str]) -> None:
        self._open.update(state)
        if self._band is not None:
            for name in fresh:
                self._names.updateValue((name,), (True,))

    def _fold(self, reads: Sequence[tuple], held: tuple | None) -> tuple[list[tuple], tuple | None, set[str]]:
        """Walk reads in order from the stored molecule: molecules that a later read has closed, the open one, and its names met in this walk."""
        state, done = held, []
        # Names of this walk are looked up here first; those of earlier walks are in state.
        fresh: set[str] = set()
        carried = state is not None
        for start, stop, name, place in reads:
            if state is None or state[1] + self._window < start:
                if state is not None:
                    done.append(state)
                if carried:
                    self._names.clear()
                state, fresh, carried = (start, stop, 1, stop - start, place), {name}, False
                continue
            mol, end, n, covered, at = state
            accepted = self._band is None or end < start or self._band[0] <= end - start <= self._band[1]
            if accepted or name in fresh or (carried and self._names.containsKey((name,))):
                state = (mol, max(end, stop), n + 1, covered + max(stop - max(start, end), 0), at)
                fresh.add(name)
        return done, state, fresh


MOLECULES = T.StructType(
    [
        T.StructField("rname", T.StringType()),
        T.StructField("bx", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("StartPosition", "EndPosition", "Reads", "Length", "BpCovered")],
    ]
)


def stream_molecules(
    reads: DataFrame,
    library_type: str = "dbs",
    window: int = DEFAULT_WINDOW,
    min_reads: int = 1,
    min_mapq: int = 0,
    lateness: str = "1 seconds",
    place: Column | None = None,
) -> DataFrame:
    """Molecules of a stream of reads under the overlap rule of ``library_type``, reported once the watermark has passed them.

    Rows that are not analyzable move the watermark, too. Reads that arrive behind it are dropped and counted by Spark
    (``numRowsDroppedByWatermark`` of the query's progress). The session needs the state store ``STATE_STORE``.
    """
    position = F.col("start") if place is None else place
    timed = reads.withColumn("place", position.cast("long")).withColumn("_at", F.timestamp_seconds("place"))
    # A condition on the time itself stays above the watermark, which other rows move, too.
    usable = timed.withWatermark("_at", lateness).where(F.when(F.col("_at") >= F.timestamp_seconds(F.lit(0)), analyzable(min_mapq)).otherwise(False))
    rows = usable.select("rname", "bx", F.col("start").cast("long"), F.col("end").cast("long"), "qname", "place", "_at")
    molecules = rows.groupBy("rname", "bx").transformWithStateInPandas(
        statefulProcessor=StrictMolecules(window, TOLERATED_OVERLAP[library_type]),
        outputStructType=MOLECULES,
        outputMode="Append",
        timeMode="EventTime",
    )
    return molecules.where(F.col("Reads") >= min_reads)


def with_end(reads: DataFrame, folder: str) -> DataFrame:
    """A stream of reads and one more, unmapped and beyond any place, which closes every molecule before it; ``folder`` is written for it."""
    spark, far = reads.sparkSession, int(datetime(9000, 1, 1, tzinfo=timezone.utc).timestamp())
    last = {"flag": 4, "start": far, "end": far, "mapq": 0}
    columns = [F.lit(last.get(f.name)).cast(f.dataType).alias(f.name) for f in reads.schema.fields]
    spark.range(1).select(*columns).write.parquet(folder)
    return reads.unionByName(spark.readStream.schema(reads.schema).parquet(folder))


def run_available(molecules: DataFrame, folder: str) -> StreamingQuery:
    """Run a stream over what its sources hold now, into a table ``molecules`` under ``folder``; returns the ended query."""
    spark = molecules.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, STATE_STORE)
    try:
        writer = molecules.writeStream.format("parquet").option("path", f"{folder}/molecules")
        query = writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    query.awaitTermination()
    return query


def new_folder(spark: SparkSession) -> str:
    """A folder for one stream among the shared files of the session."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4()}"
