"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.spec import TableSpec


def keep_one_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order_by``.

    The rank filter is planned as a group limit on both sides of the exchange, so
    each map task sends on at most one row per key however many copies there are.
    """
    best_first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_nth", F.row_number().over(best_first)).filter("_nth = 1").drop("_nth")


def current_snapshot(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Latest row per key over all slices of a Silver table."""
    return keep_one_by_key(df, spec.key, spec.ordering())
