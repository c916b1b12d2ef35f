"""Headline timings: one JSON line with the median seconds per query.

Each query is computed in full and its rows are discarded. ``BENCH_SF_DIR`` names the
tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from delayflow import registry
from delayflow.session import build_session

HEADLINES = [
    "route_avg_distance",
    "extract_features",
    "enrich_distance",
    "page_flights",
    "string_index",
    "stream_score",
    "flights_by_month",
    "null_counts",
    "distinct_rows",
    "search_flights",
    "search_airplanes",
    "correlate_request_response",
    "airplanes_per_carrier",
    "flights_per_airplane",
    "delay_histogram",
    "sort_features",
    "confusion_matrix",
    "stream_fanout",
    "job_extract",
    "page_flights_deep",
    "string_index_joined",
    "stream_correlate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINES
    spark = build_session(
        "delayflow-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    seconds: dict[str, float] = {}
    for key in wanted:
        taken = []
        # One run more than is counted: the first also loads classes and trains models.
        for _ in range(runs + 1):
            started = time.perf_counter()
            registry.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[key] = round(statistics.median(taken[1:]), 3)
    line = {
        "metric": "delayflow headline queries, sum of median wall seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "cpus": int(cpus),
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
