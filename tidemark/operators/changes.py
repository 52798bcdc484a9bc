"""Incremental pulls by a composite watermark, and applying what they bring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import current_snapshot
from tidemark.operators.ranks import rows_at_ranks
from tidemark.spec import TableSpec


def _after(df: DataFrame, columns: Sequence[str], position: Mapping[str, object]) -> Column:
    """Row-wise ``columns > position``, spelled out so that the first column reaches the scan."""
    first, *rest = columns
    bound = F.lit(position[first]).cast(df.schema[first].dataType)
    if not rest:
        return F.col(first) > bound
    return (F.col(first) >= bound) & (
        (F.col(first) > bound) | _after(df, rest, position)
    )


def changes_after(
    df: DataFrame,
    ts_col: str,
    key_cols: Sequence[str],
    watermark: Mapping[str, object] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows changed after ``watermark``, at most the ``limit`` oldest ones.

    The watermark holds a value for ``ts_col`` and for each key column: rows that
    share one timestamp can be split over batches and none is lost. A watermark
    with the timestamp alone excludes that whole instant.
    ``(ts_col, *key_cols)`` must be unique. Row order is not part of the result.
    A limit is found by range partitioning, which runs jobs: the result is a filter on
    the row it ends at, so no task ever holds a batch.
    """
    order = [ts_col, *key_cols]
    pending = df.filter(F.col(ts_col).isNotNull())
    if watermark:
        given = [c for c in order if c in watermark]
        pending = pending.filter(_after(df, given, watermark))
    if limit is None:
        return pending
    # Times travel through the driver as microseconds, free of its time zone.
    positions = pending.select(
        F.unix_micros(F.col(ts_col).cast("timestamp")).alias(ts_col), *key_cols
    )
    last = rows_at_ranks(positions, order, {None: lambda n: [limit] if n > limit else []})
    for row in last[None].values():
        end = row.asDict() | {ts_col: F.timestamp_micros(F.lit(row[ts_col]))}
        pending = pending.filter(~_after(df, order, end))
    return pending


def high_watermark(
    df: DataFrame,
    ts_col: str,
    key_cols: Sequence[str],
    fallback: Mapping[str, object] | None = None,
) -> DataFrame:
    """One row with the position of the newest change, or ``fallback`` if there is none."""
    order = [ts_col, *key_cols]
    newest = F.max(F.when(F.col(ts_col).isNotNull(), F.struct(*order)))
    top = df.agg(newest.alias("_top"))
    if fallback is None:
        return top.select(*[F.col("_top")[c].alias(c) for c in order])
    types = {c: df.schema[c].dataType for c in order}
    return top.select(
        *[
            F.when(F.col("_top").isNull(), F.lit(fallback.get(c)).cast(types[c]))
            .otherwise(F.col("_top")[c])
            .alias(c)
            for c in order
        ]
    )


def apply_changes(snapshot: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Upsert: the newer of the stored and the changed row for every key."""
    return current_snapshot(snapshot.unionByName(changes), spec)
