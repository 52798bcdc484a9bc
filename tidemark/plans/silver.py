"""Bronze to Silver.

Both functions take one slice or many: keys are unique within a slice, so a
backfill over a range of dates is one job and equals a run per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import drop_late, keep_one_by_key, standardise, with_session_metrics
from tidemark.session import staged
from tidemark.spec import EVENTS, SILVER_EVENT_SCHEMA, SLICE, TableSpec


def dedup_slices(df: DataFrame, spec: TableSpec) -> DataFrame:
    return keep_one_by_key(df, [*spec.key, SLICE], spec.ordering())


def to_silver(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows of an orders-domain table, the latest one per key and slice."""
    return dedup_slices(standardise(bronze, spec), spec)


def deduped_events(bronze: DataFrame) -> DataFrame:
    return dedup_slices(standardise(bronze, EVENTS), EVENTS)


def timely_events(bronze: DataFrame) -> DataFrame:
    """Deduplicated events without the late ones.

    Copies go first: only the earliest taken-in copy of an event is judged for lateness.
    """
    return drop_late(deduped_events(bronze))


def to_silver_events(bronze: DataFrame) -> DataFrame:
    """Finished Silver events. A session is what one slice holds of it.

    The events are staged once their copies are gone, so that is done a single time for
    the metrics and for the rows they are joined to.
    """
    events = staged(timely_events(bronze), "timely-events")
    with_metrics = with_session_metrics(events, ["session_id", SLICE])
    return with_metrics.select(SILVER_EVENT_SCHEMA.names)
