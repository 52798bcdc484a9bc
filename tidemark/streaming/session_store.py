"""Silver events stored by session, so that new events rewrite their sessions alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import in_time, standardise, with_session_metrics
from tidemark.plans.silver import dedup_slices
from tidemark.session import staging
from tidemark.sinks.manifest import RunTable, manifest_of
from tidemark.spec import EVENTS, SILVER_EVENT_SCHEMA, SLICE

TIMELY = "timely"
_STORED = T.StructType([*SILVER_EVENT_SCHEMA.fields, T.StructField(TIMELY, T.BooleanType())])
_SESSION = (SLICE, "session_id")
# What names an event once its session is known.
_EVENT = (SLICE, "event_id")


def _all(frames: Sequence[DataFrame]) -> DataFrame:
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame)
    return every


@dataclass
class SessionStore(RunTable):
    """Deduplicated events with the metrics of their session, as runs (see `RunTable`).

    A run holds whole sessions of a day: its rows hide all that older runs have of them. Late
    events are stored too, marked, as an earlier copy decides about a later one. A session that
    has lost its events leaves a row without an event until the runs are merged.
    """

    keys: Sequence[str] = _SESSION
    schema: T.StructType = field(default_factory=lambda: _STORED)

    def merged(self, runs: Sequence[DataFrame], whole: bool) -> DataFrame:
        every = runs[0]
        if len(runs) > 1:
            newer = _all([run.withColumn("_age", F.lit(k)) for k, run in enumerate(runs[1:])])
            owners = newer.groupBy(*_SESSION).agg(F.max("_age").alias("_age"))
            newest = newer.join(owners, [*_SESSION, "_age"], "left_semi").drop("_age")
            every = every.join(owners, list(_SESSION), "left_anti").unionByName(newest)
        return every.filter(F.col("event_id").isNotNull()) if whole else every

    def _days(self, days: Sequence[str] | None) -> DataFrame:
        """All that is stored of some days; the runs are sorted by day, so filters skip files."""
        runs = self.runs()
        if days is not None:
            runs = [run.filter(F.col(SLICE).isin(list(days))) for run in runs]
        return self.merged(runs, True) if runs else self.spark.createDataFrame([], _STORED)

    def events(self, days: Sequence[str] | None = None) -> DataFrame:
        """Finished Silver events, of some days or all."""
        return self._days(days).filter(TIMELY).select(SILVER_EVENT_SCHEMA.names)

    def apply(self, bronze: DataFrame) -> list[str]:
        """Take in Bronze events, again or for the first time; returns their days.

        Touched are the sessions of the new events, and those that hold another copy of one.
        Their stored events and the new ones are deduplicated and measured together and
        written as one run: what is read in full and rewritten follows those sessions.
        Equals `plans.silver.to_silver_events` over all that was ever taken in.
        """
        with staging(dedup_slices(standardise(bronze, EVENTS), EVENTS), "new-events") as new:
            days = sorted(row[0] for row in new.select(SLICE).distinct().collect())
            if not days:
                return []
            position = manifest_of(self.spark, self.path).version + 1
            if not self.runs():
                # Nothing stored: the new events are all there is of their sessions.
                self.add(self._rows(new), position)
                return days
            held = self._days(days)
            own = new.select(*_SESSION)
            copies = held.join(new.select(*_EVENT), list(_EVENT), "left_semi").select(*_SESSION)
            with staging(own.unionByName(copies).distinct(), "touched-sessions") as touched:
                old = held.join(touched, list(_SESSION), "left_semi").select(EVENTS.columns)
                events = dedup_slices(old.unionByName(new), EVENTS)
                with staging(events, "touched-events") as events:
                    emptied = touched.join(events, list(_SESSION), "left_anti")
                    self.add(self._rows(events, emptied), position)
        return days

    @staticmethod
    def _rows(events: DataFrame, emptied: DataFrame | None = None) -> DataFrame:
        """Rows of a run: deduplicated events, marked, and the sessions that have lost all theirs."""
        marked = events.withColumn(TIMELY, F.coalesce(in_time(), F.lit(False)))
        rows = with_session_metrics(marked.filter(TIMELY), list(_SESSION))
        others = [marked.filter(~F.col(TIMELY))]
        if emptied is not None:
            others.append(emptied.withColumn(TIMELY, F.lit(False)))
        for other in others:
            rows = rows.unionByName(other, allowMissingColumns=True)
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in _STORED])


def silver_store(spark: SparkSession, path: str) -> SessionStore:
    return SessionStore(spark, path)


def read_silver_events(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """Stored Silver events, of some days or all; none where nothing is stored yet."""
    return silver_store(spark, path).events(days)
