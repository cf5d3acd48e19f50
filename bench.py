"""Benchmark the headline queries.

Runs each query once to warm the session (JIT, codegen, file listing), then
three timed runs, and reports the median per query. Each run executes the
whole plan into Spark's ``noop`` sink, so nothing is collected to the driver.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma-separated subset, optional)
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "F1_net_inventory",
    "C6_hold_filter_counters",
    "B1_clean_documents",
    "B12_lookup_keys",
    "H2_prior_months",
    "F9_highlights",
    "G1_sales_summary",
    "E1_enrich",
    "E6_award_lookup",
    "J3_award_exceptions",
    "E7_priority_lookup",
    "J4_priority_exceptions",
    "E8_latest_lookup",
    "G8_master_statistics",
    "E13_summary_enriched",
    "FLOW_detail",
    "FLOW_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerlake.plans.catalog import QUERIES
    from ledgerlake.plans.session import get_session

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="ledgerlake-bench", checkpoint_dir=tempfile.mkdtemp(prefix="ledgerlake-bench-"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [n for n in HEADLINE if n in QUERIES]
    results: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
