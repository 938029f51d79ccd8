"""Headline queries, timed one after the other; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (optional)
a comma-separated subset. Every query computes all rows and columns (``noop`` sink): after one
untimed pass that warms up the JVM, the better of two timed passes counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver.queries import QUERIES  # noqa: E402
from orderloom.session import local_session  # noqa: E402

HEADLINE = [
    "region_performance",
    "retail_fct_orders",
    "o2c_fct_order_lines",
    "o2c_fct_invoices",
    "o2c_stg_payments",
    "o2c_stg_order_lines",
    "o2c_orders_with_lines",
    "aging_summary",
    "dso_customer",
    "on_time_rate",
    "dedupe_first",
    "as_of_join",
    "scd2_apply",
    "upsert",
    "check_o2c_fct_order_lines",
    "check_retail_fct_orders",
    "fct_orders_incremental",
    "snapshot_customers",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session("bench", cores)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    passes = [{name: run(name) for name in names} for _ in range(2)]
    seconds = {name: round(min(p[name] for p in passes), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
