"""Links between strings a few edits apart, from rare to frequent, by a segment index.

A string cut into ``max_dist + intact`` segments keeps ``intact`` of them unedited within ``max_dist`` edits. An unedited segment
stands in the other string at its own place, shifted by the insertions and deletions before it; shifts of successive segments, and the difference in
length that is left after the last, cannot cost more than ``max_dist`` altogether. So frequent strings are indexed by all choices
of ``intact`` segments, and rare ones look up the few places each choice may have shifted to: an equi-join without candidates that
differ in these segments.

* Counts are compared *inside the join*: only strings frequent enough for some other are indexed, only pairs of the wanted ratio are compared.
* ``intact`` follows the number of indexed strings, so that a key is expected to hold ``KEY_ROWS`` of them at most, whatever the table's
  size; all choices give the same links. Keys that stay crowded are split at run time, as both sides are plain shuffles.
* Strings look within one edit first, and only those that found no parent look further: the wider search, with its many keys, is left to few
  where frequent strings are dense.
* A string keeps its best link only, found by partial minima, so what is written is linear in the strings.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.skew import lookup
from tagweave.session import checkpointed

KEY_ROWS = 64
MOST_INTACT = 4


def _choices(max_dist: int, intact: int) -> list[tuple[int, ...]]:
    """(difference in length, number of the choice, segments, shifts) that ``max_dist`` edits allow."""
    out = []
    for number, segments in enumerate(combinations(range(max_dist + intact), intact)):
        for difference in range(-max_dist, max_dist + 1):
            for shifts in product(range(-max_dist, max_dist + 1), repeat=intact):
                steps = [shifts[0], *(b - a for a, b in zip(shifts, shifts[1:])), difference - shifts[-1]]
                if sum(map(abs, steps)) <= max_dist:
                    out.append((difference, number, *segments, *shifts))
    return out


def intact_segments(rows: int, length: int, max_dist: int) -> int:
    """How many segments a key takes so that ``rows`` strings of ``length`` bases are spread over enough keys."""
    for intact in range(1, MOST_INTACT + 1):
        if 4 ** (intact * length // (max_dist + intact)) * KEY_ROWS >= rows:
            return intact
    return MOST_INTACT


def _keys(rows: DataFrame, name: str, choices: list[tuple[int, ...]], max_dist: int, intact: int) -> DataFrame:
    """``rows`` once for every choice whose segments lie within the string: ``size`` (of the indexed string), ``choice``, ``key``."""
    fields = ["difference", "choice", *[f"g{k}" for k in range(intact)], *[f"s{k}" for k in range(intact)]]
    listed = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, values, strict=True)]) for values in choices])
    cuts = max_dist + intact
    spread = rows.withColumn("_c", F.explode(listed)).withColumn("size", F.length(name) - F.col("_c.difference"))
    inside, parts = F.col("size") >= 0, []
    for k in range(intact):
        begin, end = (F.expr(f"cast(((_c.g{k} + {step}) * size) div {cuts} as int)") for step in (0, 1))
        place = begin + F.col(f"_c.s{k}")
        inside = inside & (place >= 0) & (place + (end - begin) <= F.length(name))
        parts.append(F.substring(F.col(name), place + 1, end - begin))
    return spread.where(inside).select(*rows.columns, "size", F.col("_c.choice").alias("choice"), F.concat(*parts).alias("key"))


def parent_links(counts: DataFrame, max_dist: int = 2, ratio: int = 5, intact: int | None = None) -> DataFrame:
    """(barcode, parent, distance): for every string its parent, at least ``ratio`` times as frequent and within ``max_dist`` edits.

    Parents are the nearest, then the most frequent, then the smallest. ``counts`` is unique by ``barcode``, with counts ``n`` of 1 or more.
    """
    if ratio < 2 or max_dist < 1:
        raise ValueError("a parent is at least twice as frequent and one edit away")
    table = checkpointed(counts.select("barcode", "n"))
    rest, rounds = table, []
    # A nearer parent is the better one, so only strings without a parent at fewer edits look further.
    for edits in range(1, max_dist + 1):
        least, most = rest.agg(F.min("n")).first()[0], table.agg(F.max("n")).first()[0]
        if least is None:
            break
        rare = rest.where(F.col("n") * ratio <= most)
        rounds.append(checkpointed(_nearest(rare, table.where(F.col("n") >= least * ratio), edits, ratio, intact)))
        if edits < max_dist:
            rest = checkpointed(lookup(rare, rounds[-1].select("barcode", "distance"), "barcode").where("distance IS NULL").drop("distance"))
    if not rounds:
        return table.select("barcode", F.col("barcode").alias("parent"), F.lit(0).alias("distance"))
    return reduce(DataFrame.unionByName, rounds)


def _nearest(rare: DataFrame, frequent: DataFrame, max_dist: int, ratio: int, intact: int | None) -> DataFrame:
    """(barcode, parent, distance): the best parent of every string of ``rare`` among ``frequent``."""
    if intact is None:
        told = frequent.agg(F.count(F.lit(1)).alias("rows"), F.min(F.length("barcode")).alias("length")).first()
        intact = intact_segments(told["rows"], told["length"] or 0, max_dist)
    choices = _choices(max_dist, intact)
    # An indexed string is cut where it stands: no difference, no shifts.
    unmoved = [c for c in choices if c[0] == 0 and not any(c[2 + intact :])]
    index = _keys(frequent.select(F.col("barcode").alias("parent"), F.col("n").alias("_nb")), "parent", unmoved, max_dist, intact)
    probes = _keys(rare.select("barcode", F.col("n").alias("_na")), "barcode", choices, max_dist, intact)
    met = probes.join(index, (probes["size"] == index["size"]) & (probes["choice"] == index["choice"]) & (probes["key"] == index["key"]) & (F.col("_nb") >= F.col("_na") * ratio))
    near = met.withColumn("distance", F.levenshtein("barcode", "parent", max_dist)).where("distance >= 0")
    best = near.groupBy("barcode").agg(F.min(F.struct("distance", (-F.col("_nb")).alias("order"), "parent")).alias("_p"))
    return best.select("barcode", F.col("_p.parent").alias("parent"), F.col("_p.distance").alias("distance"))


def cluster_members(counts: DataFrame, max_dist: int = 2, ratio: int = 5, intact: int | None = None) -> DataFrame:
    """(canonical, barcode, n, size): every string with the root of its chain of parents, one row each, and its cluster's count."""
    table = checkpointed(counts.select("barcode", "n"))
    # Pointer jumping: chains strictly grow in count by the ratio, so log2(depth) rounds end it.
    links = checkpointed(parent_links(table, max_dist, ratio, intact).select("barcode", "parent"))
    while True:
        up = links.select(F.col("barcode").alias("parent"), F.col("parent").alias("_up"))
        moved = checkpointed(lookup(links, up, "parent").select("barcode", F.coalesce("_up", "parent").alias("parent"), F.col("_up").isNotNull().alias("_m")))
        links = moved.drop("_m")
        if moved.where("_m").isEmpty():
            break
    rooted = lookup(table, links, "barcode").select(F.coalesce("parent", "barcode").alias("canonical"), "barcode", "n")
    sizes = rooted.groupBy("canonical").agg(F.sum("n").alias("size"))
    return lookup(rooted, sizes, "canonical")
