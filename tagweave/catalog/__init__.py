"""Registered queries over the given tables, each with its reference SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tagweave.session import tune

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Catalog:
    """Named queries and their SQL."""

    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the decorated function under ``name``."""

        def register(function: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(tune(spark), sf_dir)

            run.__name__, run.__doc__ = function.__name__, function.__doc__
            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return function

        return register


def load_catalog() -> Catalog:
    """Collect every query module."""
    from tagweave.catalog import barcode_queries, duplicate_queries, haplotype_queries, molecule_queries, statistic_queries
    from tagweave.catalog import interval_queries, run_queries, text_queries, trimming_queries, variant_queries

    merged = Catalog()
    for module in (
        molecule_queries,
        statistic_queries,
        duplicate_queries,
        barcode_queries,
        variant_queries,
        haplotype_queries,
        interval_queries,
        text_queries,
        run_queries,
        trimming_queries,
    ):
        merged.queries.update(module.CATALOG.queries)
        merged.sql.update(module.CATALOG.sql)
    return merged
