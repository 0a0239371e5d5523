"""Time the headline queries and print one JSON line.

Each query runs once to warm up and three times measured; its median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload import QUERIES  # noqa: E402

HEADLINE = (
    "logical_completion", "latest_attempt_per_source", "date_completeness", "incomplete_summary",
    "regressed_sources", "event_row_checks", "latest_load", "lineage", "reconciliation", "recovery_plan",
    "recovery_outcome_summary", "orders_by_day", "order_items_by_parent_day", "delivery_counts",
    "slices_for_range", "business_date", "batch_membership", "header_contract", "run_json",
    "fct_orders", "fct_order_items", "customer_360", "seller_performance", "daily_revenue",
)
WRITING = ("raw_partition_replace", "append_events", "raw_csv_scan", "record_counts")


def timed(run, spark: SparkSession, sf: str) -> float:
    began = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("replaykit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE + WRITING:
        timed(QUERIES[name], spark, sf)
        seconds[name] = round(statistics.median(timed(QUERIES[name], spark, sf) for _ in range(3)), 4)
    print(json.dumps({
        "metric": "headline queries, total of warm medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
