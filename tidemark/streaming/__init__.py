from tidemark.streaming.ingest import ingest_available, landed_slices, write_stream
from tidemark.streaming.keyed import KeyedLanding
from tidemark.streaming.session_store import SessionStore, read_silver_events
from tidemark.streaming.silver import (
    dedup_stream,
    refresh_landed,
    refresh_silver_events,
    stream_silver_events,
    timely_stream,
)

__all__ = [
    "KeyedLanding",
    "SessionStore",
    "dedup_stream",
    "ingest_available",
    "landed_slices",
    "read_silver_events",
    "refresh_landed",
    "refresh_silver_events",
    "stream_silver_events",
    "timely_stream",
    "write_stream",
]
