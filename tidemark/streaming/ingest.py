"""Landing an event stream in Bronze, through one writer for all kinds of runs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks import land_batch
from tidemark.sources import read_table
from tidemark.spec import SLICE, schema_of

CONTINUOUS: Mapping[str, Any] = {"processingTime": "30 seconds"}
BOUNDED: Mapping[str, Any] = {"availableNow": True}

_LANDED = schema_of("slice string, batch string")


def landed_log(path: str) -> str:
    """Where it is noted which slices a batch of the landed table brought rows for."""
    return f"{path.rstrip('/')}_landed"


def land(batch: DataFrame, path: str, label: str, partition_by: str = SLICE) -> list[str]:
    """Land one batch, note its slices, and return them. Again is as once."""
    seen = land_batch(batch, path, label, partition_by, slices=F.collect_set(partition_by))
    spark, slices = batch.sparkSession, sorted(seen["slices"])
    noted = spark.createDataFrame([(s,) for s in slices], "slice string")
    noted.coalesce(1).write.mode("overwrite").parquet(f"{landed_log(path)}/batch={label}")
    return slices


def landed_slices(spark: SparkSession, path: str) -> DataFrame:
    """(slice, batch) of everything landed."""
    return read_table(spark, landed_log(path), _LANDED)


def lander(
    path: str, checkpoint: str, partition_by: str = SLICE, then: Callable[[SparkSession, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """What a stream does with each micro-batch. Batches are known by the feed, which is
    its checkpoint, and their number, so a batch that is run again replaces itself and
    several feeds can land in one table."""
    feed = zlib.crc32(checkpoint.rstrip("/").encode())

    def work(batch: DataFrame, number: int) -> None:
        land(batch, path, f"b{feed:08x}-{number}", partition_by)
        if then:
            then(batch.sparkSession, number)

    return work


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = CONTINUOUS,
    partition_by: str = SLICE,
) -> StreamingQuery:
    """Start landing a stream in a Parquet table.

    Offsets live in ``checkpoint``. Continuous and bounded runs of one feed share
    it, else each would take everything in for itself.
    """
    return (
        df.writeStream.outputMode("append")
        .foreachBatch(lander(path, checkpoint, partition_by))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def drain(query: StreamingQuery) -> dict[str, Any]:
    """Wait for a bounded query and add up its input over all batches.

    Spark keeps only the latest progress reports, so they are gathered on the way.
    """
    rows: dict[int, int] = {}

    def gather() -> None:
        rows.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})

    while not query.awaitTermination(1):
        gather()
    gather()
    ingested = sum(rows.values())
    return {
        "query_id": str(query.id),
        "rows_ingested": ingested,
        "status": "ingested" if ingested else "no_new_data",
    }


def ingest_available(
    df: DataFrame, path: str, checkpoint: str, partition_by: str = SLICE
) -> dict[str, Any]:
    """Take in what the source holds now, and stop."""
    query = write_stream(df, path, checkpoint, BOUNDED, partition_by)
    return {"path": path, "checkpoint": checkpoint, **drain(query)}
