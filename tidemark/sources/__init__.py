from tidemark.sources.events import parse_events, read_events
from tidemark.sources.tables import (
    GOLD_VIEWS,
    read_bronze,
    read_change_source,
    read_slice,
    read_slices,
    read_table,
    register_gold_views,
    with_audit,
    with_partition_date,
)

__all__ = [
    "GOLD_VIEWS",
    "parse_events",
    "read_bronze",
    "read_change_source",
    "read_events",
    "read_slice",
    "read_slices",
    "read_table",
    "register_gold_views",
    "with_audit",
    "with_partition_date",
]
