"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagweave.catalog import load_catalog
from tagweave.session import build_session

HEADLINE = [
    "molecule_sessions",
    "molecule_sessions_strict",
    "molecule_statistics",
    "read_molecule_tag",
    "nx_curve",
    "span_quantiles",
    "dup_positions",
    "barcode_edges",
    "barcode_components",
    "mark_duplicates",
    "barcode_correct_singles",
    "barcode_reads_join",
    "heap_bins",
    "phase_blocks",
    "switch_errors",
    "interval_overlap",
    "overlap_counts",
    "depth_sweep",
    "sv_sizes_pivot",
    "soft_filters",
    "sam_parse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINTS") or tempfile.mkdtemp(prefix="bench-"),
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_catalog().queries
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        best = None
        for _ in range(2):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - begin
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
