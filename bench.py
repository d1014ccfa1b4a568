"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver). One warm-up pass, then the
median of $BENCH_REPS timed runs per query. Each run calls the registered
query function, which builds its models anew from the files that are there, so
every figure is a cold one: planning on the driver is part of it. "queries"
holds the medians (and "value" their sum), "first_run" the first run of each
query. Prints ONE JSON line on stdout:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "latest_version_dedupe",
    "fact_order_items",
    "fact_sessions",
    "fact_fulfillment",
    "mart_sales",
    "mart_marketing",
    "mart_inventory",
    "inventory_turns",
    "hourly_sales",
    "hourly_marketing",
    "hourly_inventory",
    "dq_model_tests",
    "dq_orphans",
    "upsert_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from tidemart.plans.registry import queries
    from tidemart.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = queries()
    # warm-up: JIT, file listing caches
    qs["fact_order_items"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    first = {}
    for name in names:
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        first[name] = round(runs[0], 3)
        print(f"{name}: {times[name]}s (runs {[round(r, 2) for r in runs]})", file=sys.stderr)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median_sec",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps,
                      "first_run_total": round(sum(first.values()), 3), "first_run": first}))
    spark.stop()


if __name__ == "__main__":
    main()
