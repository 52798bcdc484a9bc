"""Parquet table writers. Each counts what it writes in the same job.

Partitioned by folder and swapped in by Spark's commit protocol: a failed job
leaves the old rows in place, but a reader that lists the folder during the swap
can see a slice half replaced. Where a table format with transactions is at hand,
its own predicate overwrite is the better sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import exists, remove
from tidemark.spec import SLICE

# Second level of folders of a landed table: which batch brought the rows.
BATCH = "batch"


def land_batch(
    df: DataFrame, path: str, label: str, partition_by: str = SLICE, **metrics: Column
) -> dict[str, Any]:
    """Make ``df`` the rows of batch ``label`` of a landed table; counts as `append_observed`.

    Each batch has a folder of its own in every slice, so one that is landed again
    replaces itself and never repeats its rows. All writers of a landed table, bounded,
    continuous and batch, go this way. A folder with the log of a streaming file sink is
    refused: readers would only see what that log names.
    """
    if exists(df.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} has a streaming sink's log, which hides other writers' rows")
    seen = Observation()
    aggregates = {"rows": F.count(F.lit(1)), **metrics}
    out = df.withColumn(BATCH, F.lit(label)).hint("rebalance", F.col(partition_by))
    (
        out.observe(seen, *[agg.alias(name) for name, agg in aggregates.items()])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by, BATCH)
        .parquet(path)
    )
    return {name: seen.get[name] for name in aggregates}


def append_observed(
    df: DataFrame, path: str, partition_by: str | None = SLICE, **metrics: Column
) -> dict[str, Any]:
    """Append, and return ``rows`` and further aggregates over the written rows.

    Rows are rebalanced by the partition column: files come out at the advisory
    size, and a date holding most of a batch is split over several tasks.
    """
    seen = Observation()
    out = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    aggregates = {"rows": F.count(F.lit(1)), **metrics}
    out = out.observe(seen, *[agg.alias(name) for name, agg in aggregates.items()])
    writer = out.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return {name: seen.get[name] for name in aggregates}


def append_counted(df: DataFrame, path: str, partition_by: str | None = SLICE) -> int:
    return int(append_observed(df, path, partition_by)["rows"])


def replace_slices(df: DataFrame, path: str, column: str, values: Sequence[str]) -> int:
    """Make ``df`` the whole content of the slices ``values`` of the table at ``path``.

    Returns the rows written. Running it again gives the same table. A slice that
    ``df`` has no rows for ends up empty. A row outside ``values`` fails the job
    before anything is swapped in.
    """
    values = [str(v) for v in dict.fromkeys(values)]
    if not values:
        return 0
    slice_text = F.col(column).cast("string")
    inside = F.when(slice_text.isin(values), slice_text).otherwise(
        F.raise_error(
            F.format_string(f"{column} %s is not among the slices to replace", slice_text)
        )
    )
    seen = Observation()
    out = df.withColumn(column, inside).hint("rebalance", F.col(column))
    (
        out.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set(column).alias("written")
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    # Dynamic overwrite does not touch slices it has no rows for.
    for value in sorted(set(values) - set(seen.get["written"])):
        remove(df.sparkSession, f"{path}/{column}={value}")
    return int(seen.get["rows"])


def replace_slice(df: DataFrame, path: str, column: str, value: str) -> int:
    return replace_slices(df, path, column, [value])


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a whole table. ``df`` must not read from ``path``."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(seen.get["rows"])
