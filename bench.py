"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` a comma-separated choice.  Each query runs once to warm up and
once measured, every result row being computed (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from docsync.plans.registry import QUERIES

HEADLINE = (
    "documents_to_rows", "typed_documents_to_rows", "extra_props_spill", "cast_matrix",
    "type_histogram", "inferred_map", "insert_ignore", "upsert_full", "upsert_partial", "delete_keys",
    "normalise_changes", "merge_updates", "fold_changes", "fold_in_batches", "operation_runs", "stream_fold",
    "retype_column", "backfill_column", "audit_rows", "snapshot_load",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    if names == ["all"]:
        names = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docsync-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run = lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
