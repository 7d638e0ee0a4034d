"""Time the headline queries over whole tables and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores. Each
query runs once to warm up; then all of them are timed in three rounds, and the median counts, so that
neither the order nor one busy moment decides; queries of over ten seconds are timed once. Results are computed in full and discarded, so no time goes into collecting
them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from touchline.plans import registry
from touchline.session import build_session

HEADLINE = [
    "to_staging",
    "with_themes",
    "top_engaged",
    "theme_counts",
    "duplicate_ids",
    "validate_tweets",
    "rejects_by_reason",
    "flatten_tweets",
    "merge_profiles",
    "run_summary",
    "read_response_pages",
    "cap_results",
    "ordered_counts",
    "latest_by_key",
    "cumulative_cost",
    "parse_app_logs",
    "alert_for",
    "group_alerts",
    "apply_retention",
    "staging_table_sink",
    "write_raw_archive",
    "archive_stream",
    "read_response_pages_all",
    "read_response_pages_many",
    "search_query",
    "stream_dedup",
    "collection_run",
    "collection_run_all",
    "sql_themes",
    "merge_profiles_as_of",
    "authors_by_range",
    "latency_quantiles",
    "heavy_authors",
    "follow_app_logs",
    "run_stream",
    "stream_validate_route",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__sql__files__maxPartitionBytes="4m",
        spark__sql__files__openCostInBytes="1m",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    runs: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for n in range(4):
        for name in HEADLINE:
            if n > 1 and runs[name][0] > 10:
                continue
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if n:
                runs[name].append(time.perf_counter() - started)
    seconds = {name: round(median(times), 3) for name, times in runs.items()}
    posts = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "stream_posts_per_sec": round(posts / seconds["run_stream"], 1),
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
