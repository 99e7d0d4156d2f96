"""Mixing sources to target weights: exact block quotas, split over output shards by a multivariate-hypergeometric tree.

The documents of a source, in an order fixed by a hash, form one stream of words; a source that has to give more than it has runs
through its stream again, up to ``MAX_REPEATS`` times. The first ``take`` words of the stream are the source's share, cut into blocks
of ``block_words`` words (the last one may be shorter). So a source is off its target by rounding to whole words only.

Blocks are dealt to shards of nearly equal numbers of blocks. A tree over the shards splits the block quotas of all sources: what the
left half gets is a multivariate-hypergeometric draw, the rest goes right, down to one vector of counts per shard. Each shard then owns a range
of ranks per source, and ranks are permuted to blocks, so shards draw disjoint blocks; within a shard blocks are shuffled. Upper nodes are
split in one task over one row per source; the subtrees below, in parallel. Every draw depends on the seed and its node only:
reruns agree, whatever the partitioning.

Defined cases: a null or empty text has size 0 and gives nothing; a null source is a source of its own and comes last; a source without words has
target 0; null ids and repeated rows are documents of their own; extra columns are ignored by :func:`mix`; an empty table
gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.session import checkpointed

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 1024
BLOCKS_PER_SHARD = 4096
SEED = 7
# Nodes of the upper tree; below them subtrees are split in parallel.
_UPPER = 1024
# Slices of a source's hash order; running sums go over rows within a slice, then over one row per slice.
_SLICE_BITS = 12
# Multipliers of the rank permutation: primes, of which one at least does not divide the number of blocks.
_PRIMES = (16_777_213, 8_388_593)
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str | Column) -> Column:
    """The number of words of a text; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """The source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size): one row per source, all sizes shared out.

    A target stops at ``repeats`` times the source's size. Sorted by that limit per weight, stopped sources come first: the common level
    of the others after the first k stop is the rest of the words over the rest of the weights, and the first k that leaves the next source
    below its limit is the right one.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int") + 1))
    limit = F.col("source_size") * repeats
    order = Window.orderBy((limit / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighted.withColumn("level", rest / left).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") * F.col("weight") <= limit, F.struct("place", "level"))
    level = F.min(fits).over(Window.partitionBy())["level"]
    return (
        levels.withColumn("level", level)
        .withColumn("target", F.when(F.col("level").isNull(), limit).otherwise(F.least(F.col("level") * F.col("weight"), limit)))
        .select("source", "source_size", "weight", F.col("target").cast("double").alias("target"))
    )


def hypergeometric(u: float, good: int, total: int, draws: int) -> int:
    """How many of ``draws`` items out of ``total``, ``good`` of them marked, are marked: the quantile ``u`` of that law."""
    low, high = max(0, draws - (total - good)), min(draws, good)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    spread = (draws * share * (1 - share) * (total - draws) / max(total - 1, 1)) ** 0.5
    reach = int(12 * spread) + 30
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (total - good - draws + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    chances = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(chances, u * chances[-1], side="right").clip(0, high - low))


def _split(low: int, high: int, counts: list[int], begins: list[int], shares, width: int, seed: int) -> Iterator[tuple]:
    """Nodes of at most ``width`` shards below the node of shards [low, high): (low, high, counts, begins)."""
    todo = [(low, high, counts, begins)]
    while todo:
        low, high, counts, begins = todo.pop()
        if high - low <= width:
            yield low, high, counts, begins
            continue
        middle = (low + high) // 2
        room, rest = shares(middle) - shares(low), sum(counts)
        luck = np.random.Generator(np.random.Philox(key=[seed, (low << 32) + high])).random(len(counts))
        left = []
        for u, own in zip(luck.tolist(), counts, strict=True):
            drawn = hypergeometric(u, own, rest, room)
            left.append(drawn)
            room, rest = room - drawn, rest - own
        right = [a - b for a, b in zip(counts, left, strict=True)]
        todo.append((low, middle, left, begins))
        todo.append((middle, high, right, [a + b for a, b in zip(begins, left, strict=True)]))


def shard_ranges(quotas: DataFrame, shards: int, blocks: int, seed: int = SEED) -> DataFrame:
    """(source, shard, begin, count): the ranks of each source's blocks that a shard owns, from (source, blocks)."""

    def shares(shard: int) -> int:
        return shard * blocks // shards

    def frame(nodes, sources) -> pd.DataFrame:
        rows = [
            (low, high, source, begin, count)
            for low, high, counts, begins in nodes
            for source, begin, count in zip(sources, begins, counts, strict=True)
            if count
        ]
        return pd.DataFrame(rows, columns=["low", "high", "source", "begin", "count"])

    width = -(-shards // _UPPER)

    def upper(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("source")
        counts = [int(n) for n in group["blocks"]]
        return frame(_split(0, shards, counts, [0] * len(counts), shares, width, seed), group["source"].tolist())

    def lower(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("source")
        counts, begins = ([int(n) for n in group[c]] for c in ("count", "begin"))
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        return frame(_split(low, high, counts, begins, shares, 1, seed), group["source"].tolist())

    schema = "low long, high long, source string, begin long, count long"
    nodes = quotas.groupBy((F.col("blocks") < 0).alias("root")).applyInPandas(upper, schema)
    leaves = nodes if width == 1 else nodes.groupBy("low", "high").applyInPandas(lower, schema)
    return leaves.select("source", F.col("low").alias("shard"), "begin", "count")


def _streamed(sized: DataFrame, seed: int) -> DataFrame:
    """``sized`` with ``start``: the words of the source's stream before the document."""
    rows = sized.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn(
        "_slice", F.shiftrightunsigned("_order", 64 - _SLICE_BITS)
    )
    sums = rows.groupBy("key", "_slice").agg(F.sum("size").alias("_words"))
    across = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("key", "_slice", F.coalesce(F.sum("_words").over(across), F.lit(0)).alias("_before"))
    within = Window.partitionBy("key", "_slice").orderBy("_order", "doc_id", "size", "told")
    local = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    return (
        rows.withColumn("_local", local)
        .join(carried, ["key", "_slice"])
        .withColumn("start", F.col("_local") + F.col("_before"))
        .drop("_order", "_slice", "_local", "_before")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """One row per document and drawn piece; a document that gives nothing has one row with null piece columns.

    Columns: doc_id, told (a hash of the text), key, size, source_size, target, start; of a piece: copy (which run through the
    stream), word_begin and word_end in the document, shard, position (of the block within its shard).
    """
    sized = checkpointed(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.xxhash64(text).alias("told"),
            F.col(source).cast("string").alias("source"),
            _source_key(F.col(source)).alias("key"),
            word_count(text).alias("size"),
        )
    )
    totals = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    shared = targets(totals.drop("key"), weights, repeats)
    plan = checkpointed(
        shared.select(
            _source_key(F.col("source")).alias("key"),
            "source_size",
            "target",
            F.floor(F.col("target") + 0.5).cast("long").alias("take"),
        ).withColumn("blocks", F.ceil(F.col("take") / block_words).cast("long"))
    )
    blocks = plan.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    shards = max(1, -(-blocks // blocks_per_shard))

    placed = _streamed(sized.drop("source"), seed).join(plan, "key")
    run_begin = F.col("copy") * F.col("source_size") + F.col("start")
    run_end = F.least(run_begin + F.col("size"), F.col("take"))
    runs = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumns(
        {"_begin": run_begin, "_end": run_end}
    )
    # Runs that give nothing get a block of their own below zero: it meets no shard, and spreads over the tasks.
    lone = F.array(-1 - F.abs(F.hash("doc_id", "told", "start")).cast("long"))
    touched = F.sequence(F.floor(F.col("_begin") / block_words), F.floor((F.col("_end") - 1) / block_words))
    pieces = (
        runs.where((F.col("_end") > F.col("_begin")) | (F.col("copy") == 0))
        .withColumn("block", F.explode(F.when(F.col("_end") > F.col("_begin"), touched).otherwise(lone)))
        .withColumn("word_begin", F.greatest(F.col("block") * block_words, "_begin") - F.col("_begin"))
        .withColumn("word_end", F.least((F.col("block") + 1) * block_words, "_end") - F.col("_begin"))
    )
    return pieces.join(_dealt(plan, shards, blocks, seed), ["key", "block"], "left").select(
        "doc_id",
        "told",
        "key",
        "size",
        "source_size",
        "target",
        "start",
        *[F.when(F.col("shard").isNotNull(), F.col(c)).alias(c) for c in ("copy", "word_begin", "word_end")],
        "shard",
        "position",
    )


def _dealt(plan: DataFrame, shards: int, blocks: int, seed: int) -> DataFrame:
    """(key, block, shard, position) of every block."""
    quotas = plan.where("blocks > 0").select(F.col("key").alias("source"), "blocks")
    ranges = shard_ranges(quotas, shards, blocks, seed).withColumnRenamed("source", "key")
    ranks = ranges.join(plan.select("key", "blocks"), "key").withColumn(
        "rank", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("count") - 1))
    )
    step = F.when(F.col("blocks") % _PRIMES[0] != 0, F.lit(_PRIMES[0])).otherwise(F.lit(_PRIMES[1])).cast("long")
    turn = F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks"))
    dealt = ranks.withColumn("block", ((F.col("rank") * step) % F.col("blocks") + turn) % F.col("blocks"))
    # At most blocks_per_shard rows, and one, share a window.
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "key", "block"), "key", "block")
    return dealt.select("key", "block", "shard", (F.row_number().over(order) - 1).cast("long").alias("position"))


def taken_words(pieces: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    words = F.when(F.col("shard").isNotNull(), F.col("word_end") - F.col("word_begin")).otherwise(0)
    # A document with words is told by its place in the stream; one without adds nothing and may share it.
    rows = pieces.groupBy("key", "start", "size", "doc_id", "told", "source_size", "target").agg(
        F.sum(words).alias("taken"), F.count_if(F.col("size") == 0).alias("empty")
    )
    return rows.withColumn("_row", F.explode(F.sequence(F.lit(1), F.greatest("empty", F.lit(1))))).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents that the mix takes words of, with ``size``, ``source_size``, ``target``, ``taken`` and ``pieces``.

    ``pieces`` lists (shard, position, copy, word_begin, word_end), so a writer of shards needs no other table. Rows repeated with the
    same id, source and text are one row, with the words and pieces of all.
    """
    pieces = mix(docs, id_column, source, text, **options).where("shard IS NOT NULL")
    piece = F.struct("shard", "position", "copy", "word_begin", "word_end")

    def named(doc_id: Column, key: Column, told: Column) -> Column:
        # A null id is told from every text an id may have.
        marked = F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("-"))
        return F.concat_ws(":", marked, told.cast("string"), key)

    taken = pieces.groupBy(named(F.col("doc_id"), F.col("key"), F.col("told")).alias("_row")).agg(
        F.max("size").alias("size"),
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.sum(F.col("word_end") - F.col("word_begin")).alias("taken"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
    )
    added = ["size", "source_size", "target", "taken", "pieces"]
    own = docs.withColumn("_row", named(F.col(id_column), _source_key(F.col(source)), F.xxhash64(text))).drop(*added)
    return own.join(taken, "_row").dropDuplicates(["_row"]).drop("_row")
