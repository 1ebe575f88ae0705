"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS``
timed runs after one warm-up run (default 3; the median counts) and
``BENCH_QUERIES`` (comma-separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_by_date", "sales_by_category", "sales_by_city", "yearly_summary", "overview_topk", "filter_options",
    "year_pruned_sales", "clean_orders", "quality_report", "dedup_first", "ingest_stats", "rollup_all",
    "rollup_region_date", "baskets_city_day", "frequent_itemsets", "assoc_rules", "fpgrowth_itemsets",
    "stocking_insights", "daily_series", "forecast_interval", "season_decompose", "behaviour_table",
    "scaled_features", "db_score", "stream_ingest", "frequent_products", "customer_portrait",
]


def main() -> None:
    from salesweft.plans.catalogue import QUERIES
    from salesweft.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    timings = {}
    for name in names:
        once(name)
        timings[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
