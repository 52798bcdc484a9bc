"""Deduplicating a stream beyond its watermark, by a stored index of keys."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import keep_one_by_key
from tidemark.session import file_names, read_file, staging, write_file
from tidemark.sinks import BATCH, land_batch
from tidemark.sources import read_slices
from tidemark.spec import EVENTS, SLICE
from tidemark.streaming.ingest import CONTINUOUS

# Stands for a slice that cannot be read.
NO_SLICE = "none"
_INDEX = T.StructType(
    [
        T.StructField("hash", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("slice", T.StringType()),
        T.StructField(BATCH, T.StringType()),
    ]
)


@dataclass(frozen=True)
class KeyedLanding:
    """A table without copies, a side table for what came too late, and the index of keys.

    Each batch has a folder of its own in all of them, so a batch that is run again replaces
    itself. The index holds the keys of every slice with their hashes, sorted by hash; a batch
    is compared with the index of its own slices only, by hash and then by the key itself, so
    no state grows in memory and a copy is known however late it comes. An event whose time lies
    more than ``delay`` before the newest of earlier batches goes to the side table, once;
    nothing is lost: both tables together hold every key once.
    """

    path: str
    late_path: str
    index_path: str
    keys: Sequence[str] = EVENTS.key
    ts_col: str = "event_timestamp"
    delay_seconds: int = 600
    partition_by: str = SLICE

    @property
    def _log(self) -> str:
        return f"{self.index_path}_batches"

    def _newest_before(self, spark: SparkSession, feed: str, number: int) -> int | None:
        """The newest event time, in microseconds, of the batches of a feed before one."""
        earlier = [n for n in file_names(spark, self._log) if n.startswith(f"{feed}-")]
        told = [
            json.loads(read_file(spark, f"{self._log}/{n}"))["newest"]
            for n in earlier
            if int(n.rsplit("-", 1)[1]) < number
        ]
        return max((t for t in told if t is not None), default=None)

    def counts(self, spark: SparkSession) -> dict[str, int]:
        """Rows taken in, kept, set aside as late and left out as copies, over all batches."""
        told = [json.loads(read_file(spark, f"{self._log}/{n}")) for n in file_names(spark, self._log) if not n.startswith(".")]
        return {c: sum(t[c] for t in told) for c in ("rows", "kept", "late", "copies")}

    def take(self, batch: DataFrame, feed: str, number: int) -> None:
        """Land one batch. Again is as once."""
        spark, label = batch.sparkSession, f"{feed}-{number}"
        key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in self.keys])
        named = batch.withColumns(
            {
                "_key": key,
                "_slice": F.coalesce(F.col(self.partition_by).cast("string"), F.lit(NO_SLICE)),
                "_at": F.unix_micros(F.col(self.ts_col)),
            }
        )
        with staging(named, "keyed-batch") as own:
            told = own.agg(F.count(F.lit(1)).alias("rows"), F.max("_at").alias("newest"), F.collect_set("_slice").alias("slices")).first()
            if not told.rows:
                return
            seen = read_slices(spark, self.index_path, _INDEX, sorted(told.slices), "slice").filter(F.col(BATCH) != label)
            first = keep_one_by_key(own, ["_slice", "_key"], [F.col("_at").asc_nulls_last(), F.col(self.ts_col)])
            marked = first.withColumn("hash", F.xxhash64("_key"))
            known = seen.select("hash", F.col("key").alias("_key"), F.col("slice").alias("_slice"))
            with staging(marked.join(known, ["hash", "_key", "_slice"], "left_anti"), "keyed-fresh") as fresh:
                before = self._newest_before(spark, feed, number)
                bound = F.lit(None if before is None else before - self.delay_seconds * 10**6).cast("long")
                late = F.coalesce(F.col("_at") < bound, F.col("_at").isNull())
                kept = land_batch(fresh.filter(~late).select(batch.columns), self.path, label, self.partition_by)
                aside = land_batch(fresh.filter(late).select(batch.columns), self.late_path, label, self.partition_by)
                # Last, as the index is what makes a row a copy.
                index = fresh.select("hash", F.col("_key").alias("key"), F.col("_slice").alias("slice"))
                land_batch(index.sortWithinPartitions("hash"), self.index_path, label, "slice")
        counts = {"rows": told.rows, "kept": kept["rows"], "late": aside["rows"]}
        counts["copies"] = counts["rows"] - counts["kept"] - counts["late"]
        write_file(spark, f"{self._log}/{label}", json.dumps({**counts, "newest": told.newest}))

    def lander(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        feed = f"b{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"
        return lambda batch, number: self.take(batch, feed, number)

    def start(self, df: DataFrame, checkpoint: str, trigger: Mapping[str, Any] = CONTINUOUS) -> StreamingQuery:
        """Start landing a stream. A feed is known by its checkpoint."""
        return (
            df.writeStream.foreachBatch(self.lander(checkpoint))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
