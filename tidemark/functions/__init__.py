from tidemark.functions.columns import (
    CLEANERS,
    ORDER_STATUS_FLOW,
    line_amount,
    mean_of_total,
    next_status,
    safe_ratio,
    utc_date,
)

__all__ = [
    "CLEANERS",
    "ORDER_STATUS_FLOW",
    "line_amount",
    "mean_of_total",
    "next_status",
    "safe_ratio",
    "utc_date",
]
