from tidemark.operators.changes import apply_changes, changes_after, high_watermark
from tidemark.operators.cleaning import drop_late, drop_malformed, in_time, require_columns, standardise
from tidemark.operators.dedup import current_snapshot, keep_one_by_key
from tidemark.operators.ranks import add_ntiles, rows_at_ranks
from tidemark.operators.rollups import ingest_profile, order_totals
from tidemark.operators.sessions import with_session_metrics

__all__ = [
    "add_ntiles",
    "apply_changes",
    "changes_after",
    "current_snapshot",
    "drop_late",
    "drop_malformed",
    "high_watermark",
    "in_time",
    "ingest_profile",
    "keep_one_by_key",
    "order_totals",
    "require_columns",
    "rows_at_ranks",
    "standardise",
    "with_session_metrics",
]
