"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line on stdout.

Every result is computed in full and discarded. Every query runs twice and the second run is timed,
so that the figure is the query and not the compiling of it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "read_envelope", "copy_into_typed", "normalise_records", "extract_years", "dedupe_first",
    "dedupe_latest", "merge_newer_wins", "merge_newer_wins_small_source", "merge_upsert",
    "merge_into_table", "rebuild_staging", "mart_summary", "summary_view", "latest_per_country",
    "trends_view", "weekly_returns", "weekly_returns_strict", "weekly_returns_coverage",
    "business_key_dups", "country_coverage", "dq_report", "pq_standard", "sq_metrics",
    "freshness", "dashboard", "quarantine_split", "stream_merge", "batch_run",
]


def timed(query, spark, sf: str) -> float:
    started = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    from snapmart.catalog import QUERIES
    from snapmart.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="12g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="snapmart-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timed(QUERIES["mart_summary"], spark, sf)
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf)
        seconds[name] = timed(QUERIES[name], spark, sf)
    scale = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
