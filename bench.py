"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder with the parquet tables, BENCH_CPUS the number of local cores. Each query runs twice,
building its plan anew each time; the second run counts and the first one is reported as ``cold``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwork.plans.catalog import QUERIES  # noqa: E402
from tillwork.session import build_session  # noqa: E402

HEADLINE = (
    "stg_store_sales",
    "sales_union",
    "int_unified_sales",
    "int_unified_returns",
    "int_net_sales",
    "int_inventory_daily",
    "item_daily_units",
    "mart_daily_revenue",
    "mart_returns_analysis",
    "mart_inventory_health",
    "mart_customer_ltv",
    "mart_promotion_effectiveness",
    "scd2_merge",
    "dq_staging_report",
    "dq_mart_report",
    "incremental_ingest",
    "refresh_counts",
)


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: round(timed(spark, folder, name), 3) for name in chosen}
    warm = {name: round(timed(spark, folder, name), 3) for name in chosen}
    spark.stop()
    scale = os.path.basename(folder).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries (second run)",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
