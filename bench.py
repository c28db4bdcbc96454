"""Benchmark: run the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Every query derives its source tables from the driver tables inside its own plan, so the times
hold all of the work.  Each is executed to completion through the ``noop`` sink (no collect to
the driver), once to warm up the JVM and code caches, then timed (best of ``$BENCH_REPEAT``
runs, default 2).  Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf"}``;
``value`` is the sum of the query times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import get_session  # noqa: E402

HEADLINE = [
    "net_revenue_month",
    "report_order_level",
    "report_monthly_pnl",
    "report_shop_day_a",
    "report_shop_day_b",
    "report_budget_matrix",
    "report_budget_use",
    "report_funnel",
    "overhead_allocation",
    "ad_spend_fullouter_day",
    "cogs_shop_day",
    "clean_orders_dedup_monthly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat + 1):          # first run warms up
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
