"""Column to Column helpers; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

CLEANERS = {
    "trim": F.trim,
    "lower": lambda c: F.lower(F.trim(c)),
    "upper": lambda c: F.upper(F.trim(c)),
    "title": lambda c: F.initcap(F.trim(c)),
}

# The order life cycle.
ORDER_STATUS_FLOW = {
    "pending": "processing",
    "processing": "shipped",
    "shipped": "delivered",
}


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, 0.0 unless the denominator is positive."""
    ratio = numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def mean_of_total(total: Column, count: Column, digits: int = 2) -> Column:
    """Rounded mean from a decimal sum and a row count, NULL for a count of zero.

    Goes through six decimals first, as ``avg`` on decimal(14,2) does, so a mean
    put together from partial sums rounds like a direct one.
    """
    mean = total.cast("decimal(24,2)") / F.nullif(count, F.lit(0))
    return F.round(mean.cast("decimal(38,6)"), digits)


def utc_date(ts: Column) -> Column:
    """Slice name (``yyyy-MM-dd`` text) of a timestamp; the session zone must be UTC."""
    return F.to_date(ts).cast("string")


def next_status(status: Column) -> Column:
    """The status an order moves to next; final and unknown ones give NULL."""
    flow = F.create_map(*[F.lit(s) for s in chain.from_iterable(ORDER_STATUS_FLOW.items())])
    return F.try_element_at(flow, status)


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).try_cast("decimal(14,2)")
