"""Headline query timings: one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS."""

from __future__ import annotations

import json
import os
import statistics
import time

from stocktake.plans.all_queries import QUERIES
from stocktake.session import build_session

HEADLINE = [
    "b2_revenue_by_region",
    "b6_order_vs_previous_order",
    "b7_order_line_receipts",
    "b8_top_customers_by_spend",
    "b11_top_products_per_category",
    "b14_three_order_moving_average",
    "b15_spending_quartile_tiers",
    "b16_region_month_dashboard",
    "b24_monthly_sales",
    "b30_purchase_revenue_by_tier",
    "a17_line_column_stats",
    "g1_running_total_over_all_orders",
    "h3_point_in_time_key_lookup",
    "h4_scd2_history_from_change_log",
    "h8_historical_attribution",
    "q15_cleaned_rows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        once(name)
    timings = {}
    for name in HEADLINE:
        timings[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median, total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
