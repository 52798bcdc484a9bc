"""What several operators share: tables, folds, small tables, connected components."""

from __future__ import annotations

import functools
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import folder_bytes, free, staged, tune

# Rows of one Arrow batch handed to Python: with texts of tens of kilobytes a batch
# stays a few dozen megabytes.
BATCH_ROWS = 500
# Bytes of one Arrow batch: what bounds it where texts are long.
BATCH_BYTES = 32 << 20
# Bytes of the texts that Python handles at once.
SLICE_BYTES = 8 << 20


# A shuffle of these operators holds at most so many times the bytes of the stored tables.
SHUFFLE_SHARE = 4


def ready(spark: SparkSession, *tables: str) -> SparkSession:
    """The session with the settings the operators rely on, and shuffle partitions for the
    tables in the folders named (none given: those of the session)."""
    tune(spark, SHUFFLE_SHARE * sum(folder_bytes(spark, t) for t in tables) or None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.addPyFile(_package(spark.sparkContext.applicationId))
    return spark


@functools.cache
def _package(_application_id: str) -> str:
    """This package as an archive, which Spark hands to the Python workers."""
    top = Path(__file__).resolve().parents[1]
    name = f"{tempfile.mkdtemp()}/{top.name}"
    return shutil.make_archive(name, "zip", top.parent, top.name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(
    batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices whose texts have about ``size`` bytes, at least a row each."""
    for batch in batches:
        column = batch.column(text)
        wide = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
        ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset + 1 : wide.offset + len(wide) + 1]
        start, begun = 0, 0 if not len(wide) else int(np.frombuffer(wide.buffers()[1], np.int64)[wide.offset])
        while start < len(wide):
            end = max(start + 1, int(np.searchsorted(ends, begun + size, side="right")))
            yield batch.slice(start, end - start)
            start, begun = end, int(ends[end - 1])


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text) % folds


def share(*columns: str | Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values of the columns alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def values(spark: SparkSession, columns: str, rows: Iterable[tuple]) -> DataFrame:
    """A small table from driver-side numbers; ``columns`` is "name type, ..."."""
    names = [c.split()[0] for c in columns.split(",")]
    kinds = [c.split()[1] for c in columns.split(",")]
    cells = ", ".join("(" + ", ".join(map(repr, row)) + ")" for row in rows)
    if not cells:
        nulls = [F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds, strict=True)]
        return spark.range(0).select(*nulls)
    raw = spark.sql(f"SELECT * FROM VALUES {cells} AS t({', '.join(names)})")
    return raw.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds, strict=True)])


def kept(df: DataFrame, label: str) -> DataFrame:
    """As `staged`, but by an eighth of the shuffle partitions (four tasks per core at least):
    for tables with a few numbers per node or link, where as many files as there are
    partitions for the texts would be mostly overhead."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) // 8
    return staged(df.coalesce(max(4 * spark.sparkContext.defaultParallelism, tasks)), label)


def components(edges: DataFrame, label: str) -> DataFrame:
    """The smallest node reachable from each node: (node, component), both long.

    ``edges`` has columns a and b. Nodes without an edge to another node are left out.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until all edges
    lead to a smallest node, which a look at the edges tells: each pass hooks a node's
    neighbours to its smallest neighbour, so the number of passes grows
    with the logarithm of a component's width, and a node of many neighbours is never
    gathered: its minimum is combined before the shuffle and joined back from a written
    table, where a hot key can be split. Each step is written to the shared folder, so
    lost executors cost no more than a step.
    """

    def pairs(a: str, b: str, df: DataFrame) -> DataFrame:
        return df.select(F.col(a).alias("a"), F.col(b).alias("b"))

    def star(df: DataFrame, large: bool) -> DataFrame:
        near = df.unionByName(pairs("b", "a", df)) if large else df
        least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        least = kept(least.withColumnRenamed("a", "u"), f"{label}-least")
        met = near.join(least, F.col("a") == F.col("u"))
        if large:
            found = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            found = pairs("b", "m", met).unionByName(own)
        return found.filter("a <> b").distinct()

    def done(df: DataFrame) -> bool:
        """Every node is either led by one other node, or leads."""
        led = df.select(F.col("a").alias("node"), F.lit(1).alias("led"), F.lit(0).alias("leads"))
        leads = df.select(F.col("b").alias("node"), F.lit(0).alias("led"), F.lit(1).alias("leads"))
        sums = led.unionByName(leads).groupBy("node").agg(F.sum("led").alias("n"), F.max("leads").alias("m"))
        return sums.filter("n + m > 1").isEmpty()

    now = edges.filter("a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    now = kept(now.distinct(), f"{label}-edges")
    while not done(now):
        wide = kept(star(now, large=True), f"{label}-wide")
        free(now)
        now = kept(star(wide, large=False), f"{label}-edges")
        free(wide)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs("a", "b", now).toDF("node", "component").unionByName(roots)
