"""Lookups of large, skewed tables in a table that is unique by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.session import checkpointed


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Left join ``rows`` to ``table`` (one row per ``keys``): the columns of ``rows``, then the values of ``table``.

    The table is written first, so the join has two plain inputs: Spark broadcasts the table where its size is known to allow
    that, and otherwise splits the partition of a hot key, or of NULL keys, over several tasks at run time. Rows are not hashed
    or compared beyond their keys, so they may hold maps.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in table.columns if c not in keys]
    held = checkpointed(
        table.select(
            *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"_value_{i}") for i, v in enumerate(values)]
        )
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{i}") for i, k in enumerate(keys)])
    kept = [c for c in rows.columns if c not in values]
    return rows.join(held, same, "left").select(*kept, *[F.col(f"_value_{i}").alias(v) for i, v in enumerate(values)])
