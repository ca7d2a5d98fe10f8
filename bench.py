"""Headline queries, timed. Prints one JSON line.

Each query runs once to warm up and then three times into the noop sink; the
median counts. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shopstrata.plans.catalogue import all_queries  # noqa: E402
from shopstrata.session import build_session  # noqa: E402

HEADLINE = [
    "fact_orders",
    "fact_daily_sales",
    "silver_orders",
    "silver_users",
    "order_rollup",
    "top_category_per_order",
    "dedup_latest",
    "upsert_scd1",
    "weather_flatten",
    "report_daily_revenue",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "shopstrata-bench",
        f"local[{cpus}]",
        cpus,
        {"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
