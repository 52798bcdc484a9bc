"""Reports over the Gold tables. Results stay DataFrames; the caller collects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio


def _in_range(funnel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    first, last = (F.lit(str(day)).cast("date") for day in (start, end))
    return funnel.filter(F.col("event_date").between(first, last))


def _mean_rate(column: str) -> Column:
    """Mean of a rate to four digits.

    Sums of doubles depend on row order; twelve decimals keep the mean repeatable.
    """
    mean = F.avg(F.col(column).cast("decimal(18,12)"))
    return F.round(mean, 4).cast("double").alias(f"avg_{column}")


def _abandonment(carts: Column, purchases: Column) -> Column:
    return F.round(safe_ratio(carts - purchases, carts), 4)


def top_revenue_products(
    funnel: DataFrame, start: str | date, end: str | date, top_n: int = 10
) -> DataFrame:
    """The most purchased products of a date range, carts deciding between equals."""
    return (
        _in_range(funnel, start, end)
        .groupBy("product_id")
        .agg(
            F.sum("purchase_count").alias("purchases"),
            F.sum("cart_count").alias("carts"),
            _mean_rate("view_to_purchase_rate"),
            _mean_rate("cart_abandonment_rate"),
        )
        .orderBy(F.desc("purchases"), F.desc("carts"), "product_id")
        .limit(int(top_n))
    )


def conversion_funnel(funnel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Totals per stage over a date range; one row, of NULL totals if nothing is in range."""
    views, carts = F.sum("page_view_count"), F.sum("cart_count")
    purchases = F.sum("purchase_count")
    return _in_range(funnel, start, end).agg(
        views.alias("total_page_views"),
        F.sum("product_click_count").alias("total_product_clicks"),
        carts.alias("total_add_to_cart"),
        F.sum("checkout_count").alias("total_checkouts"),
        purchases.alias("total_purchases"),
        F.round(safe_ratio(purchases, views), 4).alias("overall_view_to_purchase_rate"),
        _abandonment(carts, purchases).alias("overall_cart_abandonment_rate"),
    )


def hourly_traffic(traffic: DataFrame, day: str | date) -> DataFrame:
    return (
        traffic.filter(F.col("event_date") == F.lit(str(day)).cast("date"))
        .select(
            "event_date",
            "event_hour",
            "active_users",
            "total_events",
            F.round("bounce_rate", 4).alias("bounce_rate"),
            "purchases",
            F.round("avg_session_duration", 2).alias("avg_session_duration"),
        )
        .orderBy("event_hour")
    )


def customer_segments(segments: DataFrame, snapshot_date: str | date) -> DataFrame:
    """Size and mean customer of each segment at a snapshot date."""
    return (
        segments.filter(F.col("snapshot_date") == F.lit(str(snapshot_date)).cast("date"))
        .groupBy("snapshot_date", "segment_label")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.avg("recency_days"), 2).alias("avg_recency_days"),
            F.round(F.avg("frequency"), 2).alias("avg_frequency"),
            F.round(F.avg("monetary"), 2).cast("decimal(25,2)").alias("avg_monetary"),
        )
        .orderBy(F.desc("customer_count"), "segment_label")
    )


def cart_abandonment(funnel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Products by the share of carts left behind, among those put in a cart at all."""
    carts, purchases = F.sum("cart_count"), F.sum("purchase_count")
    return (
        _in_range(funnel, start, end)
        .groupBy("product_id")
        .agg(
            carts.alias("total_cart_count"),
            purchases.alias("total_purchase_count"),
            _abandonment(carts, purchases).alias("cart_abandonment_rate"),
        )
        .filter("total_cart_count > 0")
        .orderBy(F.desc("cart_abandonment_rate"), F.desc("total_cart_count"), "product_id")
    )
