"""Silver operators on streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import drop_late, standardise
from tidemark.sinks import BATCH
from tidemark.sources import read_slices, read_table
from tidemark.spec import BRONZE_EVENT_SCHEMA, EVENTS, SLICE, schema_of
from tidemark.streaming.ingest import CONTINUOUS, lander, landed_slices
from tidemark.streaming.session_store import silver_store


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = EVENTS.key,
    ts_col: str = "event_timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """First arrival of each key; state is kept for ``delay`` of event time.

    ``delay`` must cover the time between copies. Rows older than the watermark are
    dropped as well. The batch operator keeps the copy taken in first instead, which
    is the same where messages arrive in order.
    """
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def timely_stream(bronze: DataFrame) -> DataFrame:
    """Typed, complete events that arrived in time, each judged by its own arrival."""
    return drop_late(standardise(bronze, EVENTS))


def refresh_silver_events(
    spark: SparkSession, bronze_path: str, silver_path: str, days: Sequence[str]
) -> list[str]:
    """Bring whole Silver days up to date from Bronze; returns those that have events."""
    return silver_store(spark, silver_path).apply(read_slices(spark, bronze_path, BRONZE_EVENT_SCHEMA, days))


_DONE = schema_of("batch string")


def refresh_landed(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    then: Callable[[Sequence[str]], None] | None = None,
) -> list[str]:
    """Take all batches landed since the last refresh to Silver; returns the slices they touch.

    Only the rows of those batches are read, and only the sessions they touch rewritten.

    What is done is noted after the slices are in place, so a refresh that breaks off is
    made up for by the next one. ``then`` is told the slices before that.
    """
    done_path = f"{silver_path.rstrip('/')}_refreshed"
    done = read_table(spark, done_path, _DONE)
    new = landed_slices(spark, bronze_path).join(done, "batch", "left_anti")
    rows = new.collect()
    days = sorted({row.slice for row in rows})
    if days:
        batches = sorted({(row.batch,) for row in rows})
        schema = T.StructType([*BRONZE_EVENT_SCHEMA.fields, T.StructField(BATCH, T.StringType())])
        landed = read_slices(spark, bronze_path, schema, days)
        silver_store(spark, silver_path).apply(landed.filter(F.col(BATCH).isin([b for (b,) in batches])))
        if then:
            then(days)
        spark.createDataFrame(batches, _DONE).coalesce(1).write.mode("append").parquet(done_path)
    return days


def stream_silver_events(
    parsed: DataFrame,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = CONTINUOUS,
    refresh_every: int = 20,
) -> StreamingQuery:
    """Land each micro-batch, and after every ``refresh_every`` of them take those landed since
    the last time to Silver.

    Landing never rewrites a day, and refreshing rewrites the sessions that ``refresh_every``
    batches touched. What a run leaves open when it ends is done by `refresh_landed`.
    """

    def refresh(spark: SparkSession, number: int) -> None:
        if (number + 1) % refresh_every == 0:
            refresh_landed(spark, bronze_path, silver_path)

    return (
        parsed.writeStream.foreachBatch(lander(bronze_path, checkpoint, SLICE, refresh))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
