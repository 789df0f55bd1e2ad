"""Benchmark: headline reports at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is run to completion (a full write to Spark's no-op sink, so every
row is computed and nothing is pulled to the driver); the value per query is
the median of BENCH_REPEATS warm runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabula.plans.registry import QUERIES  # noqa: E402
from tabula.session import build_session  # noqa: E402

HEADLINE = [
    "join_inner_spend", "rank_top_item", "first_after_event", "points_case",
    "order_description", "net_revenue", "plan_snapshot_at_date", "day_bucket_breakdown",
    "lag_transition", "percentiles_by_group", "closing_balance_pivot", "running_balance_stats",
    "clean_weekly_sales", "before_after_by_year", "product_funnel_rates", "visit_stats",
    "campaign_summary", "delete_invalid_rows", "relational_division", "cumulative_share",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    names = [n.strip() for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n.strip()]
    extra = {"spark.driver.memory": "16g"}
    for item in filter(None, os.environ.get("BENCH_CONF", "").split(";")):  # key=value;key=value
        k, v = item.split("=", 1)
        extra[k] = v
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    layout_seconds = None
    if os.environ.get("BENCH_LAYOUT") == "bucketed":  # opt-in: co-partitioned lineitem/orders
        from tabula.sources import layout
        t0 = time.perf_counter()
        layout.use_layout(spark, sf_dir, layout.bucket_orders_and_lines(spark, sf_dir))
        layout_seconds = round(time.perf_counter() - t0, 3)
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, broadcast of literals
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
        **({"layout": "bucketed", "layout_write_sec": layout_seconds} if layout_seconds is not None else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
