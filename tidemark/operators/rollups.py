"""Small aggregates over Bronze and Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of line amounts per order, the amount an order should carry."""
    return items.groupBy("order_id").agg(
        F.sum("line_amount").cast("decimal(14,2)").alias("total_amount"),
        F.count(F.lit(1)).alias("item_count"),
    )


def ingest_profile(events: DataFrame) -> DataFrame:
    """One row: how many events, re-sent copies and late events a batch holds."""
    return events.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count("original_event_id").alias("duplicate_count"),
        F.count_if(F.col("is_late_event")).alias("late_event_count"),
    )
