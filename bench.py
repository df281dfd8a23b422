"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEATS
(default 3).  Each query is planned and run to its full result; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlark import catalog  # noqa: E402
from ledgerlark.session import build_session  # noqa: E402

HEADLINE = (
    "cleaning_audit",
    "uk_vs_others",
    "country_revenue",
    "monthly_revenue",
    "top_products",
    "product_pareto_summary",
    "large_order_impact",
    "order_value_percentiles",
    "top_customers",
    "customer_pareto",
    "vip_season",
    "chart_product_segments",
    "chart_order_histogram",
    "number_summary",
    "names_of_such_codes",
    "reconciliation",
    "log_summary",
    "event_windows",
    "event_runs",
    "brand_roi_ranking",
    "brand_pairs",
    "vip_lines",
    "chart_order_histogram_marks",
    "chart_order_box_plot",
    "reachable_suppliers_and_customers",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
