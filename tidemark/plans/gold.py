"""Silver to Gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import mean_of_total, safe_ratio
from tidemark.operators import add_ntiles

# Event types counted by the funnel, in stage order.
FUNNEL_STAGES = {
    "page_view_count": "page_view",
    "product_click_count": "product_click",
    "cart_count": "add_to_cart",
    "checkout_count": "checkout",
    "purchase_count": "purchase",
}


def on_day(df: DataFrame, ts_col: str, day: str | date | None) -> DataFrame:
    """Rows of one UTC day; becomes a timestamp range in the scan."""
    if day is None:
        return df
    return df.filter(F.to_date(ts_col) == F.lit(str(day)).cast("date"))


def sales_per_customer(orders: DataFrame) -> DataFrame:
    """Orders, those with an amount, and their money per day and customer."""
    return orders.groupBy(F.to_date("order_timestamp").alias("order_date"), "customer_id").agg(
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"),
        F.count("order_id").alias("orders"),
    )


def sales_by_country(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Daily sales from the table of `sales_per_customer`."""
    countries = customers.select("customer_id", F.col("country_code").alias("country"))
    revenue = F.sum("revenue")
    return (
        per_customer.join(countries, "customer_id", "left")
        .groupBy("order_date", "country")
        .agg(
            revenue.cast("decimal(25,2)").alias("total_revenue"),
            F.sum("orders").alias("order_count"),
            mean_of_total(revenue, F.sum("priced")).cast("decimal(19,2)").alias("avg_order_value"),
            F.count("customer_id").alias("unique_customers"),
        )
    )


def daily_sales(
    orders: DataFrame, customers: DataFrame, day: str | date | None = None
) -> DataFrame:
    """Revenue, orders and buyers per day and customer country.

    ``orders`` and ``customers`` hold one row per id (see `current_snapshot`), so
    orders and buyers can be counted without distinct sets. Orders are summed per
    day and customer before the join: a customer with a large part of all orders
    brings one row per day to it.
    """
    return sales_by_country(sales_per_customer(on_day(orders, "order_timestamp", day)), customers)


def product_funnel(events: DataFrame, day: str | date | None = None) -> DataFrame:
    """Stage counts and conversion rates per day and product.

    The abandonment rate is negative where purchases exceed carts.
    """
    counts = (
        on_day(events, "event_timestamp", day)
        .filter(F.col("product_id").isNotNull())
        .groupBy(F.to_date("event_timestamp").alias("event_date"), "product_id")
        .agg(
            *[
                F.count_if(F.col("event_type") == event_type).alias(name)
                for name, event_type in FUNNEL_STAGES.items()
            ]
        )
    )
    carts, purchases = F.col("cart_count"), F.col("purchase_count")
    return counts.withColumns(
        {
            "view_to_purchase_rate": safe_ratio(purchases, F.col("page_view_count")),
            "cart_abandonment_rate": safe_ratio(carts - purchases, carts),
        }
    )


def hourly_traffic(events: DataFrame, day: str | date | None = None) -> DataFrame:
    """Sessions by the hour they start in, and events by the hour they happen in.

    A session is what one day holds of it, so the days of a table can be built one by one
    or together. Needs event times, types and session ids alone: length and number of
    events of a session come out of the same grouping. Both groupings come from one pass
    over the events (grouping sets), and meet again as one more aggregation instead of
    a join. Hours in which no session starts are left out.
    """
    by_session, by_hour = F.grouping_id() == 1, F.grouping_id() == 2
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    both = (
        on_day(events, "event_timestamp", day)
        .select(
            "session_id",
            "event_type",
            "event_timestamp",
            F.to_date("event_timestamp").alias("day"),
            F.date_trunc("hour", "event_timestamp").alias("event_hour_start"),
        )
        .groupingSets(
            [["day", "session_id"], ["day", "event_hour_start"]],
            "day",
            "session_id",
            "event_hour_start",
        )
        .agg(
            by_session.alias("is_session"),
            F.when(by_session, F.date_trunc("hour", first))
            .otherwise(F.col("event_hour_start"))
            .alias("hour_start"),
            F.when(by_hour, F.count(F.lit(1))).alias("events"),
            (F.unix_timestamp(last) - F.unix_timestamp(first)).alias("duration"),
            F.coalesce(F.bool_or(F.col("event_type") == "purchase"), F.lit(False)).alias("bought"),
            (F.count(F.lit(1)) == 1).alias("bounced"),
        )
    )
    session = F.col("is_session")
    return (
        both.groupBy("hour_start")
        .agg(
            F.count_if(session).alias("active_users"),
            F.count_if(session & F.col("bought")).alias("purchases"),
            F.round(F.avg(F.when(session, F.col("duration"))), 2).alias("avg_session_duration"),
            F.sum("events").alias("total_events"),
            F.count_if(session & F.col("bounced")).alias("bounces"),
        )
        .filter("active_users > 0")
        .select(
            F.to_date("hour_start").alias("event_date"),
            F.hour("hour_start").alias("event_hour"),
            "active_users",
            "purchases",
            "avg_session_duration",
            "total_events",
            safe_ratio(F.col("bounces"), F.col("active_users")).alias("bounce_rate"),
        )
    )


def rfm_base(orders: DataFrame, snapshot_date: str | date) -> DataFrame:
    """Last order, number of orders and money spent per customer.

    ``orders`` holds one row per id, as for `daily_sales`.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.max(F.to_date("order_timestamp")).alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("total_amount").cast("decimal(25,2)").alias("monetary"),
    )
    return per_customer.withColumn(
        "snapshot_date", F.lit(str(snapshot_date)).cast("date")
    ).withColumn("recency_days", F.datediff("snapshot_date", "last_order_date"))


def rfm_of_days(per_customer: DataFrame, snapshot_date: str | date) -> DataFrame:
    """As `rfm_base`, from the table of `sales_per_customer`: a customer's last order is the last
    day that has any, so it also moves back when orders are taken away."""
    return (
        per_customer.groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order_date"),
            F.sum("orders").alias("frequency"),
            F.sum("revenue").cast("decimal(25,2)").alias("monetary"),
        )
        .withColumn("snapshot_date", F.lit(str(snapshot_date)).cast("date"))
        .withColumn("recency_days", F.datediff("snapshot_date", "last_order_date"))
    )


def rfm_scores(base: DataFrame, k: int = 5, tie_break: str = "customer_id") -> DataFrame:
    """Scores 1..k per dimension; recent, frequent and big customers score high.

    Stages ``base`` and runs jobs, see `add_ntiles`.
    """
    return add_ntiles(
        base,
        tie_break,
        k,
        {
            "recency_score": ("recency_days", True),
            "frequency_score": ("frequency", False),
            "monetary_score": ("monetary", False),
        },
    )


def segment_label(recency: Column, frequency: Column, monetary: Column) -> Column:
    # The thresholds and names of the segments, first match wins. A NULL score
    # meets no threshold.
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), "Champions")
        .when((recency >= 3) & (frequency >= 3), "Loyal")
        .when((recency <= 2) & (frequency >= 3), "At_Risk")
        .when((recency == 1) & (frequency <= 2), "Lost")
        .otherwise("New_Customer")
    )


def label_segments(scores: DataFrame) -> DataFrame:
    dimensions = [F.col(f"{d}_score") for d in ("recency", "frequency", "monetary")]
    return scores.withColumn("segment_label", segment_label(*dimensions))


def customer_segments(orders: DataFrame, snapshot_date: str | date) -> DataFrame:
    return label_segments(rfm_scores(rfm_base(orders, snapshot_date)))


def inventory_alerts(
    funnel: DataFrame, min_rate: float = 0.6, min_carts: int = 10, high_rate: float = 0.8
) -> DataFrame:
    """Funnel rows with many carts left behind, graded by how many."""
    rate = F.col("cart_abandonment_rate")
    return funnel.filter((rate > min_rate) & (F.col("cart_count") > min_carts)).withColumn(
        "severity", F.when(rate > high_rate, "HIGH").otherwise("MEDIUM")
    )
