"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "headline_suite_sec", "value": total, "unit": "sec",
   "queries": {name: sec, ...}, "sf": ..., ...}

Each query is executed completely (``noop`` sink: every row is produced,
nothing is collected to the driver). The JVM is warmed by one pass of every
headline query over the same tables (JIT compilation of the same code paths), so the
timings are steady-state; ``warmup_sec`` is the first pass, which also pays for
plan analysis and the count of hot orders, and ``first_query_sec`` its first
query. ``refresh_all_27_outputs`` times the whole refresh: materialise facts
once, then all 27 published tables from shared per-dimension measures, run as
concurrent jobs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.plans.catalog import queries  # noqa: E402
from orderlens.plans.refresh import refresh, run_concurrently  # noqa: E402
from orderlens.session import get_spark  # noqa: E402
from orderlens.sources.testdata import load_testdata  # noqa: E402

HEADLINE = [
    "enriched_orders",
    "order_level",
    "kpi_summary",
    "kpi_summary_order_level",
    "revenue_by_state",
    "avg_order_value_by_state",
    "late_delivery_by_state",
    "top_products",
    "orders_per_day",
    "decision_support",
    "orders_trend_forecast",
    "insight_freight_vs_price",
    "stream_ingest_roundtrip",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(
        "orderlens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", sf_dir)
    t0 = time.perf_counter()
    first_sec = 0.0
    for name in names:
        run(q[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir))
        first_sec = first_sec or round(time.perf_counter() - t0, 3)
    warm_sec = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        run(q[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    with refresh(spark, load_testdata(spark, sf_dir)) as outputs:
        run_concurrently(outputs, lambda _, df: run(df), threads=int(cpus))
    times["refresh_all_27_outputs"] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_suite_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "warmup_sec": warm_sec,
                "first_query_sec": first_sec,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
