"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2 warm
runs after the cold one), BENCH_QUERIES (comma-separated names, default HEADLINE).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tiffinmart.catalogue.queries import QUERIES
from tiffinmart.session import build_session

HEADLINE = (
    "kpi_yearly",
    "kpi_daily",
    "kpi_monthly_restaurant",
    "top10_restaurants",
    "kpi_yoy",
    "snapshot_change_feed",
    "merge_upsert_full",
    "merge_upsert_order_item",
    "scd2_customer",
    "scd2_keyed",
    "star_join_fact_current",
    "merge_fact",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    for name in names:
        times = [run(spark, name, sf_dir) for _ in range(runs + 1)]
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:] or times), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
