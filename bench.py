"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS`` the warm
runs per query (the median counts), ``BENCH_QUERIES`` a comma list to run fewer.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "diff_join", "orphan_anti_join", "mirror_status", "sync_plan", "mirror_plan", "dry_run_plan",
    "sync_summary", "validate", "validation_summary", "metadata_compare", "acl_compare",
    "acl_explode", "content_md5_join", "part_plan", "part_order", "inventory_latest",
    "checkpoint_union", "run_lookup", "last_sync_watermark", "sync_history", "progress_counts",
    "report_text", "glob_filter", "list_page",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from lading.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("lading-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lading-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(warm_runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, warm median, summed",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
