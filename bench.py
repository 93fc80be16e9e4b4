"""Benchmark: headline queries, warm median of 3 runs each.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_KEYS (comma list, optional).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each run executes the whole plan into Spark's ``noop`` sink (nothing is
collected to the driver), so timings cover scan -> shuffle -> result.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "newborn_end_to_end",   # flagship: window -> membership -> cohort -> stays -> NICU -> export
    "hospital_rollup",      # stay stitching (interval pre-aggregation + windows)
    "nicu_rollup",          # fee/readmission/provider features
    "membership_periods",   # member-months
    "tag_reference_flags",  # claim-level code flags
    "sos_rollup",           # outpatient events, salted top-3 ranking
    "request_etl",          # explode, enrich, metrics, load
    "qa_report",            # single-pass column profiles
    "code_frequency_stats", # code frequency statistics
    "run_metrics",          # one-pass run-metrics history row
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or HEADLINE

    from claimsmith.session import local_session
    from claimsmith.queries import queries
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus) * 2)))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="claimsmith-bench")
    qs = queries()
    timings, rows = {}, {}
    for k in keys:
        samples = []
        for i in range(runs + 1):  # first run warms the JVM / file caches
            t0 = time.perf_counter()
            df = qs[k](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or runs == 0:
                samples.append(dt)
            print(f"[bench] {k} run {i}: {dt:.2f}s", file=sys.stderr, flush=True)
        timings[k] = round(statistics.median(samples), 3)
        rows[k] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "sum_of_warm_median_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus), "runs": runs}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
