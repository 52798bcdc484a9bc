"""Session settings the operators rely on, and staging in the shared folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only, so they can be applied to a session that is already running.
SETTINGS = {
    # Date and hour bucketing is defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split where two shuffled tables meet; the "force" flag keeps that
    # true when a later aggregation would like to reuse the join's partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A salt next to the key of a join must take part in the partitioning.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Keys of a deduplicated stream are kept on disk, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# What a shuffle partition should hold at most; AQE merges those that hold less.
PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings above to a running session.

    ``shuffle_bytes``, the size of the largest input to be shuffled, raises the
    number of shuffle partitions to what such an input needs. AQE can merge
    partitions but, joins aside, not split them, so the default of 200 would spill
    heavily on terabytes. The session's own number is remembered: a smaller input
    afterwards goes back to it, or to what that input needs.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        name, mark = "spark.sql.shuffle.partitions", "tidemark.shuffle.partitions"
        now = spark.conf.get(name)
        own, ours = spark.conf.get(mark, f"{now} {now}").split()
        # A number that was set since, by whoever, is the session's own from now on.
        own = own if now == ours else now
        needed = str(max(int(own), -(-shuffle_bytes // PARTITION_BYTES)))
        spark.conf.set(name, needed)
        spark.conf.set(mark, f"{own} {needed}")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up for a local master, where the driver
    is the whole cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(_application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


# What this process staged, by application.
_STAGED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_staged(spark: SparkSession) -> int:
    """Delete what this session has staged; returns the number of folders.

    Frames that read from staged folders are of no use afterwards, so it is for the caller
    to say when: after a run's results are written.
    """
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    return sum(remove(spark, path) for path in paths)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; a step of the file system, no job."""
    fs, folder = _folder(spark, path)
    return int(fs.getContentSummary(folder).getLength()) if fs.exists(folder) else 0


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    fs, folder = _folder(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(folder)] if fs.exists(folder) else []


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, place = _folder(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small text file in place by one rename; false if there is one of that name."""
    fs, place = _folder(spark, path)
    if fs.exists(place):
        return False
    _, draft = _folder(spark, f"{place.getParent()}/.{place.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return bool(fs.rename(draft, place))


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return bool(fs.exists(folder))


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder of a table; a step of the file system, no job."""
    fs, folder = _folder(spark, path)
    return bool(fs.exists(folder) and fs.delete(folder, True))


def remove_file(spark: SparkSession, path: str) -> bool:
    """Delete one file."""
    fs, place = _folder(spark, path)
    return bool(fs.delete(place, False))


def remove_if_empty(spark: SparkSession, path: str) -> bool:
    """Delete a folder that holds nothing."""
    fs, folder = _folder(spark, path)
    return bool(fs.exists(folder) and not fs.listStatus(folder) and fs.delete(folder, False))


def free(*frames: DataFrame) -> None:
    """Delete what `staged` wrote for some frames, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            remove(df.sparkSession, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Runs a job. Used where several later jobs must see the very same rows: the
    files outlive lost executors and keep column pruning for each reader.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


@contextmanager
def staging(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As `staged`, for rows that are of no use after the block: the files go."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
