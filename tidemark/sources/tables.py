"""Table sources and the columns added when rows are taken in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import utc_date
from tidemark.session import exists
from tidemark.sinks.landed import is_merged, read_landed
from tidemark.sinks.manifest import is_managed, manifest_of, read_published
from tidemark.spec import SLICE


def _is_missing(error: AnalysisException) -> bool:
    """No folder, or a folder without files: nothing has been written yet."""
    return (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def _read_managed(
    spark: SparkSession, path: str, schema: T.StructType | None, values: Sequence[str] | None = None
) -> DataFrame:
    if schema is not None and is_merged(manifest_of(spark, path)):
        return read_landed(spark, path, schema, values)
    return read_published(spark, path, schema, values)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "parquet"
) -> DataFrame:
    """A stored table, as its manifest has it if there is one. With a schema, a path that does not
    exist yet is an empty table."""
    if is_managed(spark, path):
        return _read_managed(spark, path, schema)
    reader = spark.read.format(format)
    if schema is None:
        return reader.load(path)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # Folders may have more levels than the schema has columns, as landed tables do.
    return reader.schema(schema).load(path).select(schema.names)


def read_bronze(
    spark: SparkSession, path: str, silver_schema: T.StructType, format: str = "parquet"
) -> DataFrame:
    """A Bronze table in the types its source had; empty, in Silver types, if not there yet."""
    try:
        bronze = spark.read.format(format).load(path)
    except AnalysisException as error:
        if _is_missing(error):
            return spark.createDataFrame([], silver_schema)
        raise
    # Folder names that look like dates would be read as such.
    return bronze.withColumn(SLICE, F.col(SLICE).cast("string"))


def read_slice(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    value: str,
    column: str = SLICE,
    format: str = "parquet",
) -> DataFrame:
    return read_slices(spark, path, schema, [value], column, format)


def read_slices(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    values: Sequence[str],
    column: str = SLICE,
    format: str = "parquet",
) -> DataFrame:
    """Some slices of a partitioned table; only their folders are listed and read."""
    if is_managed(spark, path):
        return _read_managed(spark, path, schema, values)
    folders = [f"{path}/{column}={value}" for value in dict.fromkeys(values)]
    there = [folder for folder in folders if exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(format).schema(schema).option("basePath", path)
    return reader.load(there).select(schema.names)


def read_change_source(
    spark: SparkSession,
    table: str,
    format: str = "jdbc",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational source table.

    For JDBC give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the options so the pull is read in parallel; filters of
    `changes_after` are passed on to the database.
    """
    named = {"dbtable": table} if format == "jdbc" else {}
    return spark.read.format(format).options(**{**named, **(options or {})}).load()


def with_partition_date(df: DataFrame, ts_col: str = "updated_at") -> DataFrame:
    return df.withColumn(SLICE, utc_date(F.col(ts_col)))


def with_audit(df: DataFrame, table: str, ingested_at: Column | None = None) -> DataFrame:
    """Where a row came from and when it was taken in."""
    taken = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns({"source_table": F.lit(table), "ingested_at": taken})


# View name -> place of the table below the Gold folder.
GOLD_VIEWS = {
    "gold_daily_sales": "sales/daily_sales",
    "gold_product_funnel": "funnel/product_funnel",
    "gold_customer_segments": "segments/customer_segments",
    "gold_hourly_traffic": "traffic/hourly_traffic",
    "gold_inventory_alerts": "alerts/inventory_alerts",
}


def register_gold_views(
    spark: SparkSession, gold_root: str, format: str = "parquet"
) -> list[str]:
    """Temp views over the Gold tables that exist; returns their names."""
    registered = []
    for view, place in GOLD_VIEWS.items():
        try:
            table = read_table(spark, f"{gold_root}/{place}", format=format)
        except AnalysisException as error:
            if _is_missing(error):
                continue
            raise
        table.createOrReplaceTempView(view)
        registered.append(view)
    return registered
