"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the local cores. Each query runs once to warm up and then BENCH_RUNS
times; the median counts, from building the plan to writing every row out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import QUERIES  # noqa: E402
from tidegate.runtime import local_session  # noqa: E402

HEADLINE = [
    "stg_transactions",
    "dq_suite_tx_critical",
    "dq_suite_users_critical",
    "publish_tx_dedup",
    "publish_transactions",
    "user_metrics",
    "category_metrics",
    "daily_metrics",
    "user_activity",
    "txn_seq",
    "int_transactions",
    "fct_transactions",
    "dim_users",
    "analytics_users",
    "encrypt_users",
    "schema_drift",
    "lineage_view",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "tidegate-bench")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
