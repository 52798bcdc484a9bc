"""Suites for the Gold gates and for the constraints the source declares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.quality.alerts import SEVERITIES
from tidemark.quality.checks import (
    AllowedValues,
    Check,
    DuplicateRate,
    ForeignKey,
    NullRate,
    RowCount,
    ValueRange,
)

# Thresholds of the two gates.
DAILY_SALES_SUITE: tuple[Check, ...] = (
    RowCount(1),
    NullRate("country", 0.2),
    DuplicateRate(("order_date", "country"), 0.0),
    ValueRange("total_revenue", 0, 1_000_000_000),
)

PRODUCT_FUNNEL_SUITE: tuple[Check, ...] = (
    RowCount(1),
    NullRate("product_id", 0.0),
    DuplicateRate(("event_date", "product_id"), 0.0),
    ValueRange("cart_abandonment_rate", 0, 1),
    ValueRange("view_to_purchase_rate", 0, 1),
)

ALERTS_SUITE: tuple[Check, ...] = (
    *(NullRate(c) for c in ("alert_source", "alert_type", "severity", "alert_message")),
    AllowedValues("severity", SEVERITIES),
)


_STAMPS = ("created_at", "updated_at")


def _declared(key: str, unique: str | None, not_null: tuple[str, ...]) -> tuple[Check, ...]:
    unique_keys = (key, unique) if unique else (key,)
    return (
        *(DuplicateRate((column,)) for column in unique_keys),
        *(NullRate(column) for column in (key, *not_null)),
    )


def constraint_suites(
    customers: DataFrame, products: DataFrame, orders: DataFrame
) -> dict[str, tuple[Check, ...]]:
    """Keys, NOT NULL columns, value checks and foreign keys per source table."""
    return {
        "customers": _declared(
            "customer_id",
            "email",
            (
                "customer_external_id",
                "first_name",
                "last_name",
                "email",
                "country_code",
                "city",
                *_STAMPS,
            ),
        ),
        "products": (
            *_declared(
                "product_id",
                "product_sku",
                (
                    "product_sku",
                    "product_name",
                    "category_name",
                    "unit_price",
                    "is_active",
                    *_STAMPS,
                ),
            ),
            ValueRange("unit_price", min_value=0),
        ),
        "orders": (
            *_declared(
                "order_id",
                None,
                (
                    "order_external_id",
                    "customer_id",
                    "order_status",
                    "order_timestamp",
                    "total_amount",
                    "currency_code",
                    *_STAMPS,
                ),
            ),
            ValueRange("total_amount", min_value=0),
            ForeignKey("customer_id", customers, "customer_id"),
        ),
        "order_items": (
            *_declared(
                "order_item_id",
                None,
                ("order_id", "product_id", "quantity", "unit_price", *_STAMPS),
            ),
            ValueRange("quantity", min_value=1),
            ValueRange("unit_price", min_value=0),
            ForeignKey("order_id", orders, "order_id"),
            ForeignKey("product_id", products, "product_id"),
        ),
    }
