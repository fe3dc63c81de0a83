"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores. Each
query runs into a sink that reads every row and column. The first run of a query only
warms up; of the three behind it the median counts. ``value`` is the sum over the
headline queries, as in earlier rounds; ``others`` are timed as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import suite.registry as registry
from sheafline.session import local_session

HEADLINE = [
    "d1_raw_status_counts",
    "d3_cleaner_performance",
    "d7_run_performance",
    "d8_duplicate_title_ids",
    "d9_collection_status_counts",
    "b10_select_targets",
    "b12_poll_window",
    "c3_cleaned_with_details",
    "c5_failed_for_retry",
    "c10_attempts_of_runs",
    "c11_check_targets",
    "e1_latest_attempt",
    "e3_trailing_means",
    "f1_clean_text",
    "f5_article_transform",
    "f15_poll_transform",
    "a6_article_records",
    "v3_poll_errors",
    "v4_schema_errors",
    "v6_route",
    "w2_bulk_targets",
    "w4_merge_update",
    "w9_append_rows",
    "m1_features",
    "m5_outcome_shares",
]

#: Writes, streams and features beside the headline; not part of the sum.
OTHERS = [
    "a5_stream_sink",
    "s3_newest_rows",
    "w3_status_in_place",
    "w6_delete_in_place",
    "w7_get_or_create_schemas",
    "c7_not_cleaned_bucketed",
    "d13_median_by_ranges",
    "v4_schema_alternatives",
    "p1_clean_figures",
]


def timed(spark, name: str, folder: str) -> float:
    """Median seconds of three runs after one to warm up."""
    runs = []
    for _ in range(4):
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - start)
    return round(statistics.median(runs[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores, **{"spark.driver.memory": "8g"})
    seconds: dict[str, float] = {}
    for name in [*HEADLINE, *OTHERS]:
        seconds[name] = timed(spark, name, folder)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds[n] for n in HEADLINE), 3),
                "unit": "sec",
                "queries": {n: seconds[n] for n in HEADLINE},
                "others": {n: seconds[n] for n in OTHERS},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
