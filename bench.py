"""Time the headline queries and, next to them, the plain formulations they replace.

Prints one JSON line. ``queries`` holds seconds per query, best of `RUNS`;
``compared`` holds (ours, plain) pairs on the same input.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import tune
from tidemark.operators import add_ntiles, with_session_metrics
from tidemark.plans import gold
from tidemark.plans.catalogue import SNAPSHOT_DATE, _orders, all_queries
from tidemark.plans.silver import timely_events
from tidemark.quality import check_suite
from tidemark.quality.suites import PRODUCT_FUNNEL_SUITE
from tidemark.session import scratch_path, staged
from tidemark.sinks import append_counted
from tidemark.sources import testdata as td

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "bronze_parse_events",
    "cdc_batch_orders",
    "cdc_apply_changes",
    "silver_orders",
    "silver_order_items",
    "silver_events",
    "gold_daily_sales",
    "gold_product_funnel",
    "gold_hourly_traffic",
    "gold_customer_segments",
    "report_top_products",
    "report_segments",
    "dq_suite_orders",
    "dq_suite_events",
    "dq_constraints",
    "order_totals_rollup",
    "sink_replace_slice",
    "stream_ingest",
    "stream_silver_slices",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run: Callable[[], None], runs: int = RUNS) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def compared(spark: SparkSession) -> dict[str, dict[str, float]]:
    events = staged(timely_events(td.bronze_events(spark, SF_DIR)), "bench-events")
    base = staged(gold.rfm_base(_orders(spark, SF_DIR), SNAPSHOT_DATE), "bench-rfm")
    funnel = staged(gold.product_funnel(events), "bench-funnel")

    def tiles() -> None:
        consume(add_ntiles(base, "customer_id", 5, {"score": ("monetary", False)}))

    def global_tiles() -> None:
        order = Window.orderBy("monetary", "customer_id")
        consume(base.withColumn("score", F.ntile(5).over(order)))

    def sessions() -> None:
        consume(with_session_metrics(events))

    def windowed_sessions() -> None:
        w = Window.partitionBy("session_id")
        consume(
            events.withColumns(
                {
                    "n": F.count(F.lit(1)).over(w),
                    "a": F.min("event_timestamp").over(w),
                    "b": F.max("event_timestamp").over(w),
                    "p": F.bool_or(F.col("event_type") == "purchase").over(w),
                }
            )
        )

    def fused_checks() -> None:
        check_suite(funnel, "funnel", PRODUCT_FUNNEL_SUITE).collect()

    def single_checks() -> None:
        for check in PRODUCT_FUNNEL_SUITE:
            check_suite(funnel, "funnel", [check]).collect()

    def observed_append() -> None:
        append_counted(events, scratch_path(spark, "bench-append"))

    def counted_append() -> None:
        events.count()
        path = scratch_path(spark, "bench-append")
        events.write.mode("append").partitionBy("partition_date").parquet(path)

    pairs = {
        "ntile": (tiles, global_tiles),
        "sessions": (sessions, windowed_sessions),
        "quality_suite": (fused_checks, single_checks),
        "append": (observed_append, counted_append),
    }
    return {
        name: {"ours": seconds(ours), "plain": seconds(plain)}
        for name, (ours, plain) in pairs.items()
    }


def main() -> None:
    spark = tune(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = all_queries()
    names = sys.argv[1:] or HEADLINE
    timed = {
        name: seconds(lambda name=name: consume(catalogue[name](spark, SF_DIR))) for name in names
    }
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": SF_DIR.rsplit("/sf", 1)[-1],
    }
    if not sys.argv[1:]:
        line["compared"] = compared(spark)
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
