"""Session metrics on every event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def with_session_metrics(
    df: DataFrame,
    keys: Sequence[str] = ("session_id",),
    ts_col: str = "event_timestamp",
    type_col: str = "event_type",
) -> DataFrame:
    """Add event count, first and last time, length and conversion of each event's session.

    The metrics, one row per session, are combined on the map side and staged, then joined
    back: with no aggregate left beside it in the join, AQE can split a session of any
    size over tasks. A window would pull that session through a single one. ``df`` is read
    twice, so stage it if it is dear; ``keys`` must not be NULL. Runs a job.
    """
    first, last = F.min(ts_col), F.max(ts_col)
    metrics = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("session_event_count"),
        first.alias("session_start_time"),
        last.alias("session_end_time"),
        (F.unix_timestamp(last) - F.unix_timestamp(first)).alias("session_duration_seconds"),
        F.coalesce(F.bool_or(F.col(type_col) == "purchase"), F.lit(False)).alias("is_conversion"),
    )
    added = [c for c in metrics.columns if c not in keys]
    return df.join(staged(metrics, "session-metrics"), list(keys), "left").select(*df.columns, *added)
