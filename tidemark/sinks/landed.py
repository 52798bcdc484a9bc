"""Merging the batch folders of landed tables, behind a manifest.

A landed table has a folder per slice and batch (`land_batch`), so a feed of small batches
leaves many small files. Merging writes the rows of many batches of a slice, with the name of
their batch as a column, to a folder below ``_data``, and one rename of the manifest makes
readers take that folder instead of the files it was made of. Landing goes on as before and
knows nothing of it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import exists, file_names, folder_bytes, remove_file, remove_if_empty
from tidemark.sinks.manifest import DATA, FILE_BYTES, Manifest, commit, manifest_of
from tidemark.sinks.tables import BATCH
from tidemark.spec import SLICE

# So many small files make merging a slice worth while.
LEAST_FILES = 8
# How Spark names the folder of a null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_VERSION = "v"


def is_merged(now: Manifest) -> bool:
    """Whether a manifest is that of a landed table, rather than of a published one."""
    return "landed" in now.entries


def _string(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def _load(spark: SparkSession, base: str, places: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", base).parquet(*places)


def _load_as_is(spark: SparkSession, base: str, places: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Files with all the columns that any of them has; names of folders stay text."""
    reader = spark.read.option("basePath", base)
    found = reader.option("mergeSchema", "true").parquet(*places).schema
    return reader.schema(T.StructType([_string(f.name) if f.name in texts else f for f in found])).parquet(*places)


def _slices(spark: SparkSession, path: str, column: str | None, values: Iterable[str] | None) -> list[str]:
    """Names of slice folders; the empty name is a table without slices."""
    if column is None:
        return [""]
    if values is not None:
        return [f"{column}={value}" for value in dict.fromkeys(map(str, values))]
    return sorted(n for n in file_names(spark, path) if n.startswith(f"{column}="))


def _batch_files(
    spark: SparkSession, path: str, slices: Sequence[str], gone: frozenset[str]
) -> dict[str, list[str]]:
    """Files of batch folders by slice, without those that a merged folder stands for."""
    there = [name for name in slices if exists(spark, f"{path}/{name}")]
    files: dict[str, list[str]] = defaultdict(list)
    if there:
        listed = _load(spark, path, [f"{path}/{name}".rstrip("/") for name in there], T.StructType([_string(BATCH)]))
        depth = 2 if there == [""] else 3
        for file in listed.inputFiles():
            parts = unquote(file).split("/")[-depth:]
            if "/".join(parts) not in gone:
                files[parts[0] if depth == 3 else ""].append("/".join(parts))
    return files


def _batches(files: Mapping[str, Sequence[str]]) -> list[str]:
    """(slice folder, batch folder) of files, as text."""
    return sorted({file.rsplit("/", 1)[0] for held in files.values() for file in held})


def _folder_of_row(column: str | None) -> Column:
    batch = F.concat(F.lit(f"{BATCH}="), F.col(BATCH))
    if column is None:
        return batch
    return F.concat(F.lit(f"{column}="), F.coalesce(F.col(column), F.lit(NULL_FOLDER)), F.lit("/"), batch)


def _folders(path: str, merged: Mapping[str, Iterable[int]]) -> list[str]:
    return [f"{path}/{DATA}/{_VERSION}={v}/{name}".rstrip("/") for name, held in merged.items() for v in held]


def _merged(now: Manifest, slices: Iterable[str]) -> dict[str, list[int]]:
    held = now.entries.get("landed", {})
    return {name: [v for v, _ in held[name]] for name in slices if name in held}


def _read(
    spark: SparkSession, path: str, schema: T.StructType | None, values: Sequence[str] | None
) -> DataFrame | None:
    while True:
        now = manifest_of(spark, path)
        column = now.entries["column"]
        named = set(_slices(spark, path, column, values))
        if values is None:
            named |= set(now.entries["landed"])
        slices = sorted(named)
        files = _batch_files(spark, path, slices, frozenset(now.entries["gone"]))
        # Folders that went since would be missed by the listing.
        if manifest_of(spark, path).version == now.version:
            break
    texts = [c for c in (column, BATCH) if c]
    if schema is not None:
        schema = T.StructType([*schema.fields, *[_string(c) for c in texts if c not in schema.names]])
    frames = []
    if files:
        places = [f"{path}/{file}" for held in files.values() for file in held]
        frames.append(_load(spark, path, places, schema) if schema else _load_as_is(spark, path, places, texts))
    folders = _folders(path, _merged(now, slices))
    if folders:
        base = f"{path}/{DATA}"
        rows = _load(spark, base, folders, schema) if schema else _load_as_is(spark, base, folders, texts)
        # A batch that was landed again since it was merged stands for itself.
        again = _batches({name: held for name, held in files.items() if name in now.entries["landed"]})
        if again:
            rows = rows.filter(~_folder_of_row(column).isin(again))
        frames.append(rows.drop(_VERSION))
    if not frames:
        return None
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, values: Sequence[str] | None = None
) -> DataFrame:
    """A landed table that has been merged, or some of its slices: every row once, wherever it lies.

    ``schema`` may name the slice and batch columns. Rows are those of one manifest: a merge that
    is committed meanwhile is seen whole or not at all.
    """
    rows = _read(spark, path, schema, values)
    return spark.createDataFrame([], schema) if rows is None else rows.select(schema.names)


def read_landed_as_is(spark: SparkSession, path: str, values: Sequence[str] | None = None) -> DataFrame | None:
    """As `read_landed`, with the columns and types the batches came with; None without any."""
    return _read(spark, path, None, values)


def _drop_gone(spark: SparkSession, path: str, gone: Iterable[str]) -> None:
    """Delete files, by name, that a merged folder stands for. A batch landed again has files of
    other names, which stay."""
    folders = set()
    for file in gone:
        remove_file(spark, f"{path}/{file}")
        folders.add(file.rsplit("/", 1)[0])
    for folder in sorted(folders):
        remove_if_empty(spark, f"{path}/{folder}")


def _grown(held: Sequence[Sequence[int]], size: int, target: int) -> tuple[list[int], int]:
    """Merged folders, newest first, that a merge of ``size`` bytes takes along: those at most
    twice as large as what is merged already, so what is rewritten grows by half each time."""
    taken = []
    for version, old in reversed(held):
        if old >= target or old > 2 * size:
            break
        taken.append(version)
        size += old
    return taken, size


def merge_landed(
    spark: SparkSession,
    path: str,
    column: str | None = SLICE,
    values: Sequence[str] | None = None,
    least_files: int = LEAST_FILES,
    file_bytes: int = FILE_BYTES,
) -> dict[str, int]:
    """Merge the batch folders of a landed table, of some slices or all, where they hold at least
    ``least_files`` files that are smaller, on average, than half of ``file_bytes``.

    Readers (`read_table`, `read_slices`) see the same rows before, during and after. A row is
    rewritten a logarithmic number of times. A batch may be landed again at any time, merged or
    not: its folder then stands for it, and the next merge takes its old rows out. What a
    merge replaces stays until the next one, for readers that began before; a merge that
    breaks off changes nothing and can be run again. One merge of a table runs at a time.
    Columns that only some batches have are null for the others; batches whose types do not go
    together fail the merge. Returns how many slices, files and rows were merged.
    """
    before = manifest_of(spark, path)
    if before.version and (not is_merged(before) or before.entries["column"] != column):
        raise ValueError(f"{path} is no landed table sliced by {column}")
    held: dict[str, Any] = dict(before.entries.get("landed", {}))
    gone = before.entries.get("gone", [])
    _drop_gone(spark, path, gone)
    files = _batch_files(spark, path, _slices(spark, path, column, values), frozenset(gone))
    due: dict[str, list[str]] = {}
    taken: dict[str, list[int]] = {}
    for name, own in files.items():
        size = folder_bytes(spark, f"{path}/{name}") if name else sum(
            folder_bytes(spark, f"{path}/{file}") for file in own
        )
        if len(own) >= least_files and size < len(own) * file_bytes / 2:
            due[name] = own
            taken[name], _ = _grown(held.get(name, []), size, file_bytes)
    told = {"column": column, "landed": held, "gone": []}
    if not due:
        if gone:
            commit(spark, path, before, told)
        return {"slices": 0, "files": 0, "rows": 0}

    texts, batches = [c for c in (column, BATCH) if c], _batches(due)
    others = {name: [v for v, _ in held[name] if v not in taken[name]] for name in due if name in held}
    for name, version in _holding(spark, path, column, others, batches):
        taken[name].append(version)
    rows = _load_as_is(spark, path, [f"{path}/{file}" for own in due.values() for file in own], texts)
    old = _folders(path, taken)
    if old:
        kept = _load_as_is(spark, f"{path}/{DATA}", old, texts).drop(_VERSION)
        kept = kept.filter(~_folder_of_row(column).isin(batches))
        rows = rows.unionByName(kept, allowMissingColumns=True)
    version = before.version + 1
    folder, seen = f"{path}/{DATA}/{_VERSION}={version}", Observation()
    shaped = rows.hint("rebalance", *texts[:-1]).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = shaped.sortWithinPartitions(*texts).write.mode("overwrite")
    (writer.partitionBy(column) if column else writer).parquet(folder)
    for name in due:
        rest = [entry for entry in held.get(name, []) if entry[0] not in taken[name]]
        held[name] = [*rest, [version, folder_bytes(spark, f"{folder}/{name}".rstrip("/"))]]
    told["gone"] = [file for own in due.values() for file in own]
    retired = [f"{_VERSION}={v}/{name}".rstrip("/") for name, versions in taken.items() for v in versions]
    commit(spark, path, before, told, retired)
    return {"slices": len(due), "files": len(told["gone"]), "rows": int(seen.get["rows"])}


def _holding(
    spark: SparkSession,
    path: str,
    column: str | None,
    merged: Mapping[str, Sequence[int]],
    batches: Sequence[str],
) -> list[tuple[str, int]]:
    """(slice folder, version) of merged folders that hold earlier rows of batches. Only the
    batch column is read; it is sorted."""
    folders = _folders(path, merged)
    if not folders:
        return []
    schema = T.StructType([*[_string(c) for c in (column, BATCH) if c], T.StructField(_VERSION, T.IntegerType())])
    rows = _load(spark, f"{path}/{DATA}", folders, schema).filter(_folder_of_row(column).isin(list(batches)))
    name = F.regexp_replace(_folder_of_row(column), f"/?{BATCH}=[^/]*$", "")
    return [(row.name, row[_VERSION]) for row in rows.select(name.alias("name"), _VERSION).distinct().collect()]
