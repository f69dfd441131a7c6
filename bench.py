"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from bytesift.queries import QUERIES

HEADLINE = [
    "benchmark_totals",
    "contains_docs",
    "find_short_pattern",
    "find_overlapping_pattern",
    "find_repeated_mark_split",
    "find_common_patterns",
    "find_common_patterns_hash",
    "find_benchmark_in_documents",
    "find_words_in_documents",
    "hash_join_benchmark",
    "chunked_benchmark",
    "split_in_eight",
    "count_per_document",
    "count_benchmark_per_document",
    "pattern_totals",
    "first_k_report",
    "strategy_diff",
    "pattern_profile",
    "nested_patterns",
    "mask_of_benchmark_in_documents",
    "find_markup_in_pages",
    "file_range_totals",
    "conversation_straddle",
    "stream_find_benchmark",
    "stream_conversation_straddle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bytesift-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first query pays for starting the JVM; it is run once unmeasured
    QUERIES["contains_docs"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        best = None
        for _ in range(3):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the best of three runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
