"""Votes at variant sites, summed where reads meet the sites.

Reads and sites are dealt to *tiles* of ``TILE`` positions and sorted there: first the sites of a tile, then its reads by barcode and
name. One pass over a partition projects a batch of reads at a time, joins the mates of a name, and gives sums of a barcode (or of a name
without one). So reads are moved once, single votes are not moved at all, and a pass holds the sites of one tile, a batch, and one open name.
A crowded tile is dealt to several shares, each with its own copy of the sites; sums of different shares and batches add up later.

Sums are cut into *runs* of neighbouring sites: a run ends where the next site is more than ``gap`` away. Molecules are further apart
than that, so a run lies in one molecule, which its first position tells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.operators.alleles import Sites, project
from tagweave.session import checkpointed

TILE = 1 << 14
# Reads that one share of a tile takes, and the shares that reads of one barcode are dealt over in a crowded tile.
SHARE_READS = 1 << 18
BARCODE_SHARES = 8
# Pairs of a read and a site that are held at once.
HELD_PAIRS = 1 << 20
GROUP = "_group"
_KEYS = ("rname", "_tile", "_share")
_NUMBERS = ("ps", "idx", "span", "zero")
_WIDTHS = (1, 2, 4, 8)


def _tiles(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(first / F.lit(TILE)), F.floor(last / F.lit(TILE))))


def _dealt(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """Reads and sites in one table, by tile and share, sorted: sites first, then reads by ``GROUP`` and name."""
    own = [GROUP, "qname", "start", "end", "cigar", "sequence", "quality"]
    usable = reads.where(" AND ".join(f"{c} IS NOT NULL" for c in ("rname", "start", "end", "cigar", "sequence"))).select("rname", *own)
    placed = usable.withColumn("_tile", _tiles(F.col("start"), F.greatest("start", F.col("end") - 1)))
    counts = checkpointed(placed.groupBy("rname", "_tile").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    # Few rows: each stands for at least SHARE_READS reads.
    crowded = counts.where(F.col("n") > SHARE_READS).select("rname", "_tile", F.ceil(F.col("n") / SHARE_READS).cast("int").alias("_shares"))
    crowded = F.broadcast(crowded)
    turn = F.pmod(F.xxhash64("qname"), F.when(F.col(GROUP).isNull(), F.col("_shares")).otherwise(F.least("_shares", F.lit(BARCODE_SHARES))))
    share = F.pmod(F.pmod(F.xxhash64(GROUP), F.lit(1 << 30)) + turn, F.col("_shares"))
    shared = placed.join(crowded, ["rname", "_tile"], "left").withColumn("_share", F.coalesce(share, F.lit(0)).cast("int")).drop("_shares")

    numbers = [(F.col(c) if c in sites.columns else F.lit(None)).cast("long").alias(c) for c in _NUMBERS]
    told = sites.select(
        F.col("chrom").alias("rname"), F.col("pos").cast("long").alias("start"), F.floor(F.col("pos") / F.lit(TILE)).alias("_tile"), F.struct(*numbers, "first", "second").alias("site")
    )
    told = told.where("rname IS NOT NULL AND start IS NOT NULL").join(crowded, ["rname", "_tile"], "left")
    copies = told.withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    both = copies.unionByName(shared, allowMissingColumns=True).select(*_KEYS, *own, "site")
    # Without a number, small partitions are merged at run time.
    tasks = math.ceil(total / SHARE_READS)
    usual = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(tasks, *_KEYS) if tasks > usual else both.repartition(*_KEYS)
    return dealt.sortWithinPartitions("_tile", "rname", "_share", F.col("site").isNull(), GROUP, "qname")


def _codes(column: pa.Array) -> np.ndarray:
    """Numbers that are equal where neighbouring rows are; NULL is a value."""
    return pc.fill_null(pc.dictionary_encode(column).indices, -1).to_numpy(zero_copy_only=False)


def _changes(columns: Sequence[np.ndarray], first: bool) -> np.ndarray:
    """True where a row differs from the one before; ``first`` is told for the first row."""
    out = np.zeros(len(columns[0]), dtype=bool)
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    out[:1] = first
    return out


def _starts(changes: np.ndarray) -> np.ndarray:
    """Places where a group begins, the first row's included."""
    return np.flatnonzero(np.concatenate(([True], changes[1:]))) if len(changes) else np.zeros(0, dtype=np.int64)


class _Table:
    """Sites of the tiles of a batch, in order of tile and place."""

    def __init__(self):
        self.tile = self.pos = np.zeros(0, dtype=np.int64)
        self.numbers = {c: np.zeros(0, dtype=np.int64) for c in _NUMBERS}
        self.known = np.zeros(0, dtype=bool)
        self.alleles = [pa.array([], pa.string())] * 2
        self._settled()

    def _settled(self) -> None:
        self.octets = []
        for texts in self.alleles:
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            first = pc.binary_slice(texts.cast(pa.binary()), 0, 1).to_pylist() if len(texts) else []
            self.octets.append((sizes, np.frombuffer(b"".join(x or b"\0" for x in first), dtype=np.uint8)))
        self.single = (self.numbers["span"] == 1) & (self.octets[0][0] == 1) & (self.octets[1][0] == 1)
        new = _changes([self.tile, self.pos], True) if len(self.pos) else np.zeros(0, dtype=bool)
        # Records of one place count as its first.
        self.lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, dtype=np.int64)

    def _taken(self, at: np.ndarray) -> None:
        self.tile, self.pos, self.known = self.tile[at], self.pos[at], self.known[at]
        self.numbers = {c: x[at] for c, x in self.numbers.items()}
        self.alleles = [x.take(pa.array(at)) for x in self.alleles]
        self._settled()

    def add(self, tile: np.ndarray, pos: np.ndarray, site: pa.StructArray) -> None:
        if not len(tile):
            return
        self.tile, self.pos = np.concatenate((self.tile, tile)), np.concatenate((self.pos, pos))
        fields = {c: pc.struct_field(site, c) for c in (*_NUMBERS, "first", "second")}
        self.known = np.concatenate((self.known, fields["ps"].is_valid().to_numpy(zero_copy_only=False)))
        for c in _NUMBERS:
            self.numbers[c] = np.concatenate((self.numbers[c], pc.fill_null(fields[c], 0).to_numpy(zero_copy_only=False)))
        self.alleles = [pa.concat_arrays([x, pc.fill_null(fields[c].cast(pa.string()), "")]) for x, c in zip(self.alleles, ("first", "second"))]
        self._taken(np.lexsort((self.numbers["ps"], self.numbers["idx"], self.pos, self.tile)))

    def keep(self, tile: int) -> int:
        """Only the sites of one tile stay, under the number 0; the number of sites that went before them."""
        at = np.flatnonzero(self.tile == tile)
        gone = int(at[0]) if len(at) else 0
        if len(at) < len(self.tile):
            self._taken(at)
        self.tile = np.zeros(len(at), dtype=np.int64)
        return gone

    def met(self, tile: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first site of each read's span in its tile, and how many there are."""
        if not len(self.pos):
            return np.zeros(len(tile), dtype=np.int64), np.zeros(len(tile), dtype=np.int64)
        low = min(self.pos.min(), start.min(initial=self.pos[0]))
        wide = max(self.pos.max(), end.max(initial=0), start.max(initial=0)) - low + 2
        keys = self.tile * wide + (self.pos - low)
        first, last = (np.searchsorted(keys, tile * wide + (x - low), side="left") for x in (start, np.maximum(start, end)))
        return first, last - first

    def sides(self, site: np.ndarray, seen: pa.StringArray) -> np.ndarray:
        """0 or 1 for the allele that is shown, -1 for none."""
        ends = np.frombuffer(seen.buffers()[1], dtype=np.int32).astype(np.int64) if len(seen) else np.zeros(1, dtype=np.int64)
        sizes, octets = np.diff(ends), np.frombuffer(seen.buffers()[2] or b"", dtype=np.uint8)
        out = np.full(len(site), -1, dtype=np.int8)
        for side in (1, 0):
            wanted, first = self.octets[side]
            same = sizes == wanted[site]
            same &= octets[np.minimum(ends[:-1], max(len(octets) - 1, 0))] == first[site] if len(octets) else False
            # Longer ones are compared as wholes.
            long = np.flatnonzero(same & (sizes > 1))
            if len(long):
                same[long] = pc.equal(seen.take(pa.array(long)), self.alleles[side].take(pa.array(site[long]))).to_numpy(zero_copy_only=False)
            out[same] = side
        return out


class _Pass:
    """One pass over the sorted rows of a partition; ``emit`` turns summed runs into a batch."""

    def __init__(self, emit, gap: int | None, slot: int, by_set: bool):
        self.emit, self.gap, self.slot, self.by_set = emit, gap, slot, by_set
        self.table = _Table()
        self.key = self.name = None
        self.tile = 0
        # Votes of the last name, which may go on: site, least and greatest side, quality.
        self.open = [np.zeros(0, dtype=np.int64)] * 4

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from self._batch({n: batch.column(k) for k, n in enumerate(batch.schema.names)})
        yield from self._flushed()

    def _flushed(self) -> Iterator[pa.RecordBatch]:
        none = np.zeros(1, dtype=np.int64)
        yield from self._closed([], *self.open, np.zeros(len(self.open[0]), dtype=np.int64), none, none - 1)
        self.open = [x[:0] for x in self.open]

    def _batch(self, held: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
        # Tiles are numbered from the one that may go on, 0.
        keys = [_codes(held[c]) if c == "rname" else held[c].to_numpy(zero_copy_only=False) for c in _KEYS]
        first, last = (tuple(held[c][k].as_py() for c in _KEYS) for k in (0, -1))
        tile = np.cumsum(_changes(keys, first != self.key))
        is_site = held["site"].is_valid().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(is_site)
        start = held["start"].to_numpy(zero_copy_only=False).astype(np.int64)
        self.table.add(tile[at], start[at], held["site"].take(pa.array(at)))
        rows = np.flatnonzero(~is_site)
        if len(rows):
            reads = {c: x.take(pa.array(rows)) for c, x in held.items() if c != "site"} if len(rows) < len(is_site) else held
            tiles, starts = tile[rows], start[rows]
            ends = reads["end"].to_numpy(zero_copy_only=False).astype(np.int64)
            begin, counts = self.table.met(tiles, starts, ends)
            part = (np.cumsum(counts) - counts) // HELD_PAIRS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(rows)]
            for a, b in zip(cuts, cuts[1:]):
                piece = {c: x.slice(a, b - a) for c, x in reads.items()}
                yield from self._reads(piece, tiles[a:b], starts[a:b], begin[a:b], counts[a:b])
        # Sites and the open name belong to the last tile from here on.
        going_on = tile[-1] == self.tile
        if not going_on:
            yield from self._flushed()
        gone = self.table.keep(int(tile[-1]))
        self.open[0] = self.open[0] - gone
        self.key, self.tile = last, 0 if going_on else -1

    def _reads(self, reads: dict[str, pa.Array], tiles: np.ndarray, starts: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        group, name = reads[GROUP], reads["qname"]
        groups, alone = _codes(group), group.is_null().to_numpy(zero_copy_only=False)
        before, now = self.name, (reads["rname"][0].as_py(), group[0].as_py(), name[0].as_py())
        same_tile = before is not None and tiles[0] == self.tile and now[0] == before[0]
        new_group = _changes([tiles, groups], not (same_tile and now[1] == before[1]))
        new_name = new_group | _changes([_codes(name)], not (same_tile and now[1:] == before[1:]))
        names = np.cumsum(new_name)
        group_at = np.cumsum(new_group | (alone & new_name))
        at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        table = self.table
        own = Sites(counts, table.pos[at], table.numbers["span"][at], table.single[at])
        rows, picked, seen, least = project(reads["cigar"].to_pylist(), starts, reads["sequence"], reads["quality"], own)
        site = at[picked]
        side = table.sides(site, seen)
        of = np.flatnonzero(side >= 0)
        votes = [table.lead[site[of]], side[of].astype(np.int64), side[of].astype(np.int64), least[of].astype(np.int64)]
        votes = [np.concatenate(x) for x in zip(self.open, votes)]
        voters = np.concatenate((np.zeros(len(self.open[0]), dtype=np.int64), names[rows[of]]))
        # Mates that show one allele count once.
        order = np.lexsort((votes[0], voters))
        voters, votes = voters[order], [x[order] for x in votes]
        cut = _starts(_changes([voters, votes[0]], True))
        if len(cut):
            voters = voters[cut]
            votes = [votes[0][cut], np.minimum.reduceat(votes[1], cut), np.maximum.reduceat(votes[2], cut), np.maximum.reduceat(votes[3], cut)]
        done = voters < names[-1]
        # The group of every name, and a row that tells it; what goes on from before has none.
        group_of = np.concatenate(([0], group_at[new_name]))
        rep = np.full(int(group_at[-1]) + 1, -1)
        opened = np.flatnonzero(_changes([group_at], group_at[0] > 0))
        rep[group_at[opened]] = opened
        yield from self._closed([reads["rname"], group, name], *(x[done] for x in votes), voters[done], group_of, rep)
        self.open = [x[~done] for x in votes]
        k = len(tiles) - 1
        self.name = tuple(x[k].as_py() for x in (reads["rname"], group, name))
        self.tile = int(tiles[-1])

    def _closed(self, told: list[pa.Array], lead, low, high, quality, voters, group_of, rep) -> Iterator[pa.RecordBatch]:
        """Sums of the votes of closed names, by group and site."""
        agreed = np.flatnonzero(low == high)
        if not len(agreed):
            return
        lead, groups = lead[agreed], group_of[voters[agreed]]
        weight = np.where(low[agreed] == 0, quality[agreed], -quality[agreed])
        order = np.lexsort((lead, groups))
        lead, groups, weight = lead[order], groups[order], weight[order]
        cut = _starts(_changes([groups, lead], True))
        lead, groups, weight = lead[cut], groups[cut], np.add.reduceat(weight, cut)
        some = np.flatnonzero(weight)
        if not len(some):
            return
        lead, groups, weight = lead[some], groups[some], weight[some]
        before = self.name or (None, None, None)
        held = [pa.array([b], pa.string()) for b in before]
        told = [pa.concat_arrays([h, t.cast(pa.string())]) for h, t in zip(held, told)] if told else held
        pos = self.table.pos[lead]
        alone = told[1].take(pa.array(rep + 1)).is_null().to_numpy(zero_copy_only=False)[groups]
        edge = pos // self.slot
        new = _changes([groups, self.table.numbers["ps"][lead]] if self.by_set else [groups], True)
        far = np.zeros(len(pos), dtype=bool)
        far[1:] = edge[1:] != edge[:-1]
        if self.gap is not None:
            far[1:] |= np.diff(pos) > self.gap
        runs = _starts(new | (far & ~alone))
        who = pa.array(rep[groups[runs]] + 1)
        rname, group, name = (x.take(who) for x in told)
        name = pc.if_else(group.is_valid(), pa.scalar(None, pa.string()), name)
        yield self.emit([rname, group, name], self.table, lead, pos, weight, runs)


def _passed(reads: DataFrame, sites: DataFrame, more: str, emit, gap: int | None, slot: int, by_set: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Pass(emit, gap, slot, by_set).run(batches)

    return _dealt(reads, sites).mapInArrow(work, f"rname string, {GROUP} string, qname string, {more}")


def phase_set_runs(reads: DataFrame, sites: DataFrame, gap: int | None, slot: int) -> DataFrame:
    """(rname, GROUP, qname, at, ps, balance): votes of a barcode, summed over runs of sites of one phase set, and their first position.

    ``reads`` has ``rname, qname, start, end, cigar, sequence, quality`` and ``GROUP``: a barcode, or NULL for reads that stand for their name;
    only those keep ``qname``. ``balance`` counts qualities of the genotype's first allele less those of the second. A run lies in one
    ``slot`` of positions.
    """

    def emit(told, table, lead, pos, weight, runs) -> pa.RecordBatch:
        sets = pa.array(table.numbers["ps"][lead[runs]], mask=~table.known[lead[runs]])
        return pa.RecordBatch.from_arrays([*told, pa.array(pos[runs]), sets, pa.array(np.add.reduceat(weight, runs))], names=["rname", GROUP, "qname", "at", "ps", "balance"])

    return _passed(reads, sites, "at long, ps long, balance long", emit, gap, slot, True)


def _narrow(values: np.ndarray, runs: np.ndarray, signed: bool) -> tuple[np.ndarray, list[bytes]]:
    """Every run as bytes, in the least width that holds its numbers, and these widths."""
    sizes = np.diff(np.append(runs, len(values)))
    most = np.maximum.reduceat(np.abs(values), runs)
    limits = [(1 << (8 * w - signed)) - 1 for w in _WIDTHS[:-1]]
    width = np.array(_WIDTHS)[np.searchsorted(limits, most)]
    whole = {w: values.astype(f"<{'i' if signed else 'u'}{w}").tobytes() for w in set(width.tolist())}
    return width, [whole[w][w * i : w * (i + n)] for w, i, n in zip(width.tolist(), runs.tolist(), sizes.tolist())]


def _wide(texts: pa.Array, width: np.ndarray, counts: np.ndarray, signed: bool) -> np.ndarray:
    """The numbers of all runs, one behind the other."""
    out = np.zeros(counts.sum(), dtype=np.int64)
    for w in set(width.tolist()):
        mine = np.flatnonzero(width == w)
        octets = b"".join(texts.take(pa.array(mine)).to_pylist())
        out[np.repeat(width == w, counts)] = np.frombuffer(octets, dtype=f"<{'i' if signed else 'u'}{w}")
    return out


def allele_runs(reads: DataFrame, sites: DataFrame, gap: int | None, slot: int) -> DataFrame:
    """(rname, GROUP, qname, at, first, n, form, steps, balances): balances of a barcode at its sites, packed by runs.

    As :func:`phase_set_runs`, with ``idx`` and ``zero`` of the sites: ``first`` is the first ``idx``, ``steps`` how far each lies behind the
    one before, and ``balances`` count allele 0 against allele 1. Both are bytes of the widths that ``form`` tells.
    """

    def emit(told, table, lead, pos, weight, runs) -> pa.RecordBatch:
        idx = table.numbers["idx"][lead]
        steps = np.diff(idx, prepend=0)
        steps[runs] = 0
        sign = np.where(table.numbers["zero"][lead] == 0, weight, -weight)
        (wide, far), (deep, sums) = _narrow(steps, runs, False), _narrow(sign, runs, True)
        sizes = np.diff(np.append(runs, len(lead)))
        columns = [pa.array(pos[runs]), pa.array(idx[runs]), pa.array(sizes), pa.array(wide * 16 + deep), pa.array(far, pa.binary()), pa.array(sums, pa.binary())]
        return pa.RecordBatch.from_arrays([*told, *columns], names=["rname", GROUP, "qname", "at", "first", "n", "form", "steps", "balances"])

    return _passed(reads, sites, "at long, first long, n long, form long, steps binary, balances binary", emit, gap, slot, False)


def _texts(octets: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(octets)))


def joined_runs(runs: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """(keys, variants, blocks): all runs of a key as blocks of neighbouring ``idx``, (first, alleles, qualities) in order.

    The heavier allele of a site is taken, with what it outweighs the other by, ``most`` at most; even sites are left out. Runs of a key come in
    order, and only the key that may go on is held.
    """
    keys = list(keys)
    rows = runs.select(*keys, "first", "n", "form", "steps", "balances").repartition(*keys).sortWithinPartitions(*keys, "first")
    block = T.StructType([T.StructField("first", T.LongType()), T.StructField("alleles", T.StringType()), T.StructField("qualities", T.StringType())])
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("variants", T.LongType()), T.StructField("blocks", T.ArrayType(block))])

    def told(columns: list[pa.Array], of: np.ndarray, idx: np.ndarray, balance: np.ndarray) -> pa.RecordBatch:
        """Blocks of whole keys; ``of`` tells the row of ``columns``."""
        if len(idx) and ((np.diff(of) == 0) & (np.diff(idx) <= 0)).any():
            order = np.lexsort((idx, of))
            of, idx, balance = of[order], idx[order], balance[order]
            cut = _starts(_changes([of, idx], True))
            of, idx, balance = of[cut], idx[cut], np.add.reduceat(balance, cut)
        some = np.flatnonzero(balance)
        of, idx, balance = of[some], idx[some], balance[some]
        new = _changes([of, idx - np.arange(len(idx))], True)
        at = np.flatnonzero(new)
        ends = np.append(at, len(idx))
        alleles = _texts(np.where(balance > 0, 48, 49).astype(np.uint8), ends)
        marks = _texts((np.minimum(np.abs(balance), most) + 33).astype(np.uint8), ends)
        first = _starts(_changes([of[at]], True)) if len(at) else np.zeros(0, dtype=np.int64)
        blocks = pa.StructArray.from_arrays([pa.array(idx[at]), alleles, marks], names=["first", "alleles", "qualities"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), blocks)
        sizes = np.diff(np.append(at[first], len(idx)))
        whose = pa.array(of[at[first]])
        return pa.RecordBatch.from_arrays([*[c.take(whose) for c in columns], pa.array(sizes), lists], names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept = None, []

        def rest() -> pa.RecordBatch:
            idx, balance = (np.concatenate(x) for x in zip(*kept))
            columns = [pa.array([v], kind) for v, kind in zip(key, kinds)]
            return told(columns, np.zeros(len(idx), dtype=np.int64), idx, balance)

        kinds: list[pa.DataType] = []
        for whole in batches:
            sizes = whole.column("n").to_numpy(zero_copy_only=False)
            part = (np.cumsum(sizes) - sizes) // HELD_PAIRS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                batch = whole.slice(a, b - a)
                columns = [batch.column(k) for k in range(len(keys))]
                kinds = [c.type for c in columns]
                counts, form = sizes[a:b], batch.column("form").to_numpy(zero_copy_only=False)
                idx = np.cumsum(_wide(batch.column("steps"), form // 16, counts, False))
                balance = _wide(batch.column("balances"), form % 16, counts, True)
                at = np.cumsum(counts) - counts
                idx += np.repeat(batch.column("first").to_numpy(zero_copy_only=False) - idx[at], counts)
                now = tuple(c[0].as_py() for c in columns)
                row = np.cumsum(_changes([_codes(c) for c in columns], False))
                row_at = np.flatnonzero(_changes([row], True))
                of = np.repeat(row, counts)
                if kept and now != key:
                    yield rest()
                    kept = []
                # The last key may go on; the first may have begun before.
                ends = np.searchsorted(of, [0, row[-1]], side="right")
                start = int(np.searchsorted(of, row[-1], side="left"))
                if row[-1] > 0:
                    if kept:
                        kept.append((idx[: ends[0]], balance[: ends[0]]))
                        key = now
                        yield rest()
                        kept = []
                        low = int(ends[0])
                    else:
                        low = 0
                    if start > low:
                        yield told([c.take(pa.array(row_at)) for c in columns], of[low:start], idx[low:start], balance[low:start])
                kept.append((idx[start:], balance[start:]))
                key = tuple(c[len(c) - 1].as_py() for c in columns)
        if kept:
            yield rest()

    return rows.mapInArrow(work, schema)
