"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "build_dataset", "code_units", "prose_sections", "prose_pairs", "discover_links", "article_dispatch",
    "sitemap_urls", "filter_all", "exact_dedup", "format_fim", "format_instruction", "train_eval_split",
    "seeded_shuffle", "write_jsonl", "read_jsonl", "build_counters", "eval_summary", "eval_compare",
    "parse_judge", "parse_chat_response", "route_requests", "route_requests_by_table", "route_log_model",
    "request_metrics", "request_metrics_stream", "near_dedup", "build_from_sources", "merge_sources",
)


def session(cpus: int | str):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def main() -> None:
    from millrace.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name in HEADLINE:
        # Twice, and the second run counts: the first one compiles code.
        for _ in range(2):
            start = time.perf_counter()
            # The noop sink computes every column of every row and keeps nothing.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
