"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs
``BENCH_RUNS`` times (2) to the last row; the best time counts, so that JVM
start-up is not part of it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from paperloom.plans import registered

HEADLINE = [
    "search_with_metadata",
    "knn_exact_batch",
    "knn_single",
    "knn_ivf_full_probe",
    "changelog_compact",
    "upsert_last_wins",
    "embedding_text",
    "embed_hashed",
    "keyword_bm25",
    "eval_all",
    "evaluate_vector_run",
    "parse_citation_records",
    "changes_from_citation_files",
    "title_match",
    "qrels_resolve",
    "batch_ranges",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("paperloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered.queries()
    times = {}
    for name in wanted:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )


if __name__ == "__main__":
    main()
