"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the best counts (default 1)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from courierlake.session import build_session  # noqa: E402

HEADLINE = [
    "agg_basic",
    "dedup_latest",
    "silver_orders",
    "silver_payments",
    "silver_delivery",
    "silver_billing",
    "silver_customers",
    "gold_dim_customers",
    "gold_dim_restaurants",
    "agg_payments_summary",
    "mart_revenue",
    "mart_subscription",
    "window_range_growth",
    "kpi_revenue",
    "kpi_churn_rate",
    "eda_cohort",
    "eda_pareto",
    "stream_land_parquet",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        f"local[{cpus}]", app="bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(min(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
