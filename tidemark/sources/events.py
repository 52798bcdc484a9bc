"""Clickstream messages: reading them and opening their JSON payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import utc_date
from tidemark.spec import EVENT_SCHEMA, schema_of

# What a topic delivers, for file sources that stand in for one.
MESSAGE_SCHEMA = schema_of("key binary, value binary, timestamp timestamp")

# Read a new topic from its start, and go on when old data has expired.
KAFKA_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_events(
    spark: SparkSession,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Raw messages (key, value, timestamp) from any source Spark can read."""
    reader = spark.readStream if streaming else spark.read
    defaults = KAFKA_OPTIONS if format == "kafka" else {}
    reader = reader.format(format).options(**{**defaults, **(options or {})})
    return (reader.schema(schema) if schema else reader).load()


def parse_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Messages to typed Bronze events, batch or stream.

    Nothing is dropped here: a broken payload gives NULL fields, and a row without
    a readable event time lands in the NULL slice, where it can be looked at.
    """
    message = raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_message_timestamp"),
        F.from_json(F.col("value").cast("string"), schema).alias("event"),
    )
    return (
        message.select("kafka_key", "kafka_message_timestamp", "event.*")
        .withColumns(
            {
                "event_timestamp": F.col("event_timestamp").try_cast("timestamp"),
                "ingestion_timestamp": F.col("ingestion_timestamp").try_cast("timestamp"),
                "bronze_ingested_at": F.current_timestamp(),
            }
        )
        .withColumn("partition_date", utc_date(F.col("event_timestamp")))
    )
