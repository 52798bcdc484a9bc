"""Row-level operators: validation, typing, dropping. None of them shuffles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

# Fixed value: how long after its event time an event may arrive.
LATE_TOLERANCE = "10 minutes"


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """Fail at planning time, without a job, when the projection cannot work."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df


def drop_malformed(df: DataFrame, required: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(required))


def standardise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Clean, cast and order the columns of ``spec``; drop rows lacking required values."""
    require_columns(df, spec.columns, spec.name)
    if spec.check_raw:
        df = drop_malformed(df, spec.required)
    typed = df.select(*[field.column() for field in spec.fields])
    return typed if spec.check_raw else drop_malformed(typed, spec.required)


def in_time(
    event_ts: str = "event_timestamp",
    ingest_ts: str = "ingestion_timestamp",
    tolerance: str = LATE_TOLERANCE,
) -> Column:
    """Whether a row arrived within ``tolerance`` of happening, the limit included."""
    return F.col(event_ts) + F.expr(f"INTERVAL {tolerance}") >= F.col(ingest_ts)


def drop_late(
    df: DataFrame,
    event_ts: str = "event_timestamp",
    ingest_ts: str = "ingestion_timestamp",
    tolerance: str = LATE_TOLERANCE,
) -> DataFrame:
    """Keep rows that arrived within ``tolerance`` of happening, the limit included."""
    return df.filter(in_time(event_ts, ingest_ts, tolerance))
