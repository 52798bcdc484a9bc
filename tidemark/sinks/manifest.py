"""Tables whose live folders a manifest names. One rename of the manifest switches them.

Data folders lie below ``_data`` and are never changed once written: a commit writes new ones,
then a manifest of the next number. Readers take the manifest of the highest number and read
what it names, so they see a table as it was before a commit or as it is after it. What a
commit retires stays until the next one, for readers that began before. Each table has one
writer at a time; the file system must rename a file in one step (as HDFS and local ones do).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import exists, file_names, folder_bytes, read_file, remove, write_file

MANIFEST = "_manifest"
DATA = "_data"


class CommitConflict(RuntimeError):
    """Another writer has committed since the table was looked at."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    entries: Mapping[str, Any] = field(default_factory=dict)
    retired: Sequence[str] = ()


def is_managed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{MANIFEST}")


def manifest_of(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest; version 0 without entries if there is none."""
    numbers = [int(name) for name in file_names(spark, f"{path}/{MANIFEST}") if name.isdigit()]
    if not numbers:
        return Manifest()
    told = json.loads(read_file(spark, f"{path}/{MANIFEST}/{max(numbers):012d}"))
    return Manifest(max(numbers), told["entries"], told["retired"])


def commit(
    spark: SparkSession, path: str, before: Manifest, entries: Mapping[str, Any], retired: Sequence[str] = ()
) -> Manifest:
    """Make ``entries`` the table, and remove what the commit ``before`` retired."""
    after = Manifest(before.version + 1, dict(entries), list(retired))
    text = json.dumps({"entries": after.entries, "retired": after.retired})
    if not write_file(spark, f"{path}/{MANIFEST}/{after.version:012d}", text):
        raise CommitConflict(f"{path} has a version {after.version} already")
    for folder in before.retired:
        remove(spark, f"{path}/{DATA}/{folder}")
    if before.version > 1:
        remove(spark, f"{path}/{MANIFEST}/{before.version - 1:012d}")
    return after


def _slice_folder(version: int, column: str | None, value: str) -> str:
    return f"v={version}/{column}={value}" if column else f"v={version}"


def publish_slices(df: DataFrame, path: str, column: str, values: Sequence[str]) -> int:
    """Make ``df`` the whole content of the slices ``values`` of the table at ``path``.

    Returns the rows written. All slices change at once: no reader sees some replaced and others
    not, or a slice without rows on the way. A slice that ``df`` has no rows for is gone
    afterwards. A row outside ``values`` fails the job, and nothing changes.
    """
    values = [str(v) for v in dict.fromkeys(values)]
    if not values:
        return 0
    text = F.col(column).cast("string")
    stray = F.format_string(f"{column} %s is not among the slices to replace", text)
    inside = F.when(text.isin(values), text).otherwise(F.raise_error(stray))
    return _publish(df.withColumn(column, inside), path, column, values, df.schema)


def publish_table(df: DataFrame, path: str, column: str | None = None) -> int:
    """Replace a whole table, which may be sliced by ``column``; it may read from itself."""
    return _publish(df, path, column, None, df.schema)


def _publish(
    df: DataFrame, path: str, column: str | None, values: Sequence[str] | None, schema: T.StructType
) -> int:
    spark = df.sparkSession
    before = manifest_of(spark, path)
    held = dict(before.entries.get("slices", {}))
    if before.version and before.entries.get("column") != column:
        if values is not None:
            raise ValueError(f"{path} is sliced by {before.entries.get('column')}, not by {column}")
    version = before.version + 1
    seen = Observation()
    written = F.collect_set(F.col(column).cast("string")) if column else F.array(F.lit(""))
    writer = (
        (df.hint("rebalance", F.col(column)) if column else df)
        .observe(seen, F.count(F.lit(1)).alias("rows"), written.alias("written"))
        .write.mode("overwrite")
    )
    (writer.partitionBy(column) if column else writer).parquet(f"{path}/{DATA}/v={version}")
    named = seen.get["written"] if column else [""]
    replaced = held if values is None else {v: held[v] for v in values if v in held}
    rest = {v: n for v, n in held.items() if v not in replaced}
    slices = rest | dict.fromkeys(named, version)
    retired = [_slice_folder(n, before.entries.get("column"), v) for v, n in replaced.items()]
    commit(spark, path, before, {"column": column, "slices": slices, "schema": schema.json()}, retired)
    return int(seen.get["rows"])


def read_published(
    spark: SparkSession, path: str, schema: T.StructType | None = None, values: Sequence[str] | None = None
) -> DataFrame:
    """A published table, or some of its slices, as the newest manifest has it."""
    entries = manifest_of(spark, path).entries
    if "slices" not in entries:
        raise ValueError(f"{path} is no published table; a table of runs is read by its own class")
    schema = schema or T.StructType.fromJson(json.loads(entries["schema"]))
    column, held = entries.get("column"), entries.get("slices", {})
    wanted = held if values is None else [v for v in dict.fromkeys(map(str, values)) if v in held]
    folders = [f"{path}/{DATA}/{_slice_folder(held[v], column, v)}" for v in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/{DATA}")
    return reader.parquet(*folders).select(schema.names)


# --- tables of runs -------------------------------------------------------------------

# So many runs of a level are merged into one of the next.
FAN = 8
# Rows of all newer runs, as a share of the oldest one's, from which on all are merged.
REWRITE_SHARE = 0.25
# What a file of merged batches should hold.
FILE_BYTES = 128 * 1024 * 1024
# What a file of a merged run should hold; one task sorts and writes it.
RUN_BYTES = 32 * 1024 * 1024


@dataclass
class RunTable:
    """A log-structured table: immutable runs sorted by key, oldest first, behind a manifest.

    A commit adds one small run, so it writes as much as it changes. Runs are merged by
    levels: `FAN` of a level become one of the next, and all become one when the newer ones hold
    a share of the oldest (`REWRITE_SHARE`); a row is rewritten a logarithmic number of times.
    Merged runs are ranges of keys, in files of `RUN_BYTES`, sorted inside: filters on
    keys skip files. ``position`` is what the writer has taken in so far, committed with it.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    schema: T.StructType

    def merged(self, runs: Sequence[DataFrame], whole: bool) -> DataFrame:
        """Runs, oldest first, as one; ``whole``: no older run is left beside it."""
        raise NotImplementedError

    @property
    def position(self) -> int:
        return int(manifest_of(self.spark, self.path).entries.get("position", 0))

    def _load(self, run: Mapping[str, Any]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{DATA}/{run['folder']}")

    def runs(self, now: Manifest | None = None) -> list[DataFrame]:
        now = now or manifest_of(self.spark, self.path)
        return [self._load(run) for run in now.entries.get("runs", [])]

    def read(self) -> DataFrame:
        runs = self.runs()
        return self.merged(runs, True).select(self.schema.names) if runs else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame, folder: str, files: int | None = None) -> int:
        seen = Observation()
        shaped = df.repartitionByRange(files, *self.keys) if files else df
        out = shaped.select(self.schema.names).sortWithinPartitions(*self.keys)
        out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path}/{DATA}/{folder}")
        return int(seen.get["rows"])

    def add(self, df: DataFrame, position: int, **entries: Any) -> Manifest:
        """Commit one more run, then merge what is due."""
        before = manifest_of(self.spark, self.path)
        folder = self._next_run(before)
        return self._commit_run(before, folder, self._write(df, folder), position, **entries)

    @staticmethod
    def _next_run(before: Manifest) -> str:
        return f"run/v={before.version + 1}"

    def _commit_run(self, before: Manifest, folder: str, rows: int, position: int, **entries: Any) -> Manifest:
        runs = [*before.entries.get("runs", []), {"folder": folder, "rows": rows, "level": 0}]
        told = {**before.entries, **entries, "runs": runs, "position": position}
        now = commit(self.spark, self.path, before, told)
        while (due := self._due(now.entries["runs"])) is not None:
            now = self._merge(now, due)
        return now

    @staticmethod
    def _due(runs: Sequence[Mapping[str, Any]]) -> int | None:
        """From which run on all newer ones are to be merged; none: not now."""
        if len(runs) > 1 and sum(r["rows"] for r in runs[1:]) > REWRITE_SHARE * runs[0]["rows"]:
            return 0
        for k in range(len(runs) - FAN + 1):
            if k and len({r["level"] for r in runs[k:]}) == 1:
                return k
        return None

    def _merge(self, now: Manifest, first: int) -> Manifest:
        runs = list(now.entries["runs"])
        old = runs[first:]
        size = sum(folder_bytes(self.spark, f"{self.path}/{DATA}/{r['folder']}") for r in old)
        folder = f"run/v={now.version + 1}"
        rows = self._write(
            self.merged([self._load(r) for r in old], first == 0), folder, max(1, -(-size // RUN_BYTES))
        )
        level = 1 + max(r["level"] for r in old)
        told = {**now.entries, "runs": [*runs[:first], {"folder": folder, "rows": rows, "level": level}]}
        return commit(self.spark, self.path, now, told, [r["folder"] for r in old])


@dataclass
class SumTable(RunTable):
    """Additive totals by key: a run holds signed sums, and a key's total is the sum over runs.

    Merging everything drops keys whose sums are all 0. Keys may be null.
    """

    sums: Sequence[str] = ()

    def merged(self, runs: Sequence[DataFrame], whole: bool) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        kinds = {f.name: f.dataType for f in self.schema}
        total = every.groupBy(*self.keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in self.sums])
        if not whole:
            return total
        left: Column = F.lit(False)
        for c in self.sums:
            left = left | (F.coalesce(F.col(c), F.lit(0)) != 0)
        return total.filter(left)
