"""Declarative table descriptions: columns, cleaning, required values, identity."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import CLEANERS

SLICE = "partition_date"

_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(14,2)": T.DecimalType(14, 2),
}


def schema_of(columns: str) -> T.StructType:
    """Schema from "name type, name type"; unlike Spark's own it needs no session."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    clean: str | None = None

    def column(self) -> Column:
        """Cleaned and cast value; a value that does not fit the type becomes NULL."""
        value = F.col(self.name)
        if self.clean:
            value = CLEANERS[self.clean](value)
        return value.try_cast(self.type).alias(self.name)


@dataclass(frozen=True)
class TableSpec:
    """One Silver table.

    ``order`` ranks the copies of one key, best copy first, as (column, direction).
    ``check_raw`` tells whether required values are tested before the casts, or on
    the cast values so that unreadable ones count as missing.
    """

    name: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    key: tuple[str, ...]
    order: tuple[tuple[str, str], ...]
    check_raw: bool = True

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _TYPES[f.type]) for f in self.fields])

    def ordering(self) -> list[Column]:
        return [getattr(F.col(name), direction)() for name, direction in self.order]

    def with_tiebreak(self, *order: tuple[str, str]) -> TableSpec:
        """Same table with further ranking columns, for feeds whose copies can tie."""
        return replace(self, order=self.order + order)


def _audited(*fields: Field) -> tuple[Field, ...]:
    return fields + (
        Field("created_at", "timestamp"),
        Field("updated_at", "timestamp"),
        Field("source_table"),
        Field("ingested_at", "timestamp"),
        Field(SLICE),
    )


_LATEST = (("updated_at", "desc"), ("ingested_at", "desc"))

CUSTOMERS = TableSpec(
    name="customers",
    fields=_audited(
        Field("customer_id", "bigint"),
        Field("customer_external_id"),
        Field("first_name", clean="title"),
        Field("last_name", clean="title"),
        Field("email", clean="lower"),
        Field("country_code", clean="upper"),
        Field("city", clean="title"),
    ),
    required=("customer_id", "email", "updated_at"),
    key=("customer_id",),
    order=_LATEST,
)

PRODUCTS = TableSpec(
    name="products",
    fields=_audited(
        Field("product_id", "bigint"),
        Field("product_sku", clean="upper"),
        Field("product_name", clean="trim"),
        Field("category_name", clean="trim"),
        Field("unit_price", "decimal(12,2)"),
        Field("is_active", "boolean"),
    ),
    required=("product_id", "product_sku", "updated_at"),
    key=("product_id",),
    order=_LATEST,
)

ORDERS = TableSpec(
    name="orders",
    fields=_audited(
        Field("order_id", "bigint"),
        Field("order_external_id"),
        Field("customer_id", "bigint"),
        Field("order_status", clean="lower"),
        Field("order_timestamp", "timestamp"),
        Field("total_amount", "decimal(14,2)"),
        Field("currency_code", clean="upper"),
    ),
    required=("order_id", "customer_id", "order_status", "updated_at"),
    key=("order_id",),
    order=_LATEST,
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    fields=_audited(
        Field("order_item_id", "bigint"),
        Field("order_id", "bigint"),
        Field("product_id", "bigint"),
        Field("quantity", "int"),
        Field("unit_price", "decimal(12,2)"),
        Field("line_amount", "decimal(14,2)"),
    ),
    required=("order_item_id", "order_id", "product_id", "updated_at"),
    key=("order_item_id",),
    order=_LATEST,
)

EVENTS = TableSpec(
    name="events",
    fields=(
        Field("event_id"),
        Field("session_id"),
        Field("user_id"),
        Field("event_type", clean="lower"),
        Field("event_timestamp", "timestamp"),
        Field("ingestion_timestamp", "timestamp"),
        Field("bronze_ingested_at", "timestamp"),
        Field("page_url"),
        Field("product_id", "int"),
        Field("category_name"),
        Field("country_code", clean="upper"),
        Field("device_type", clean="lower"),
        Field("traffic_source", clean="lower"),
        Field("event_position", "int"),
        Field("is_late_event", "boolean"),
        Field("original_event_id"),
        Field(SLICE),
    ),
    required=(
        "event_id",
        "session_id",
        "user_id",
        "event_type",
        "event_timestamp",
        "ingestion_timestamp",
        SLICE,
    ),
    key=("event_id",),
    order=(("ingestion_timestamp", "asc"), ("bronze_ingested_at", "asc")),
    check_raw=False,
)

ORDER_TABLES = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}


def order_table(name: str) -> TableSpec:
    if name not in ORDER_TABLES:
        raise ValueError(f"no such orders table: {name!r}, expected one of {sorted(ORDER_TABLES)}")
    return ORDER_TABLES[name]


# The JSON payload of one clickstream message; both times travel as ISO-8601 text.
EVENT_SCHEMA = schema_of(
    "event_id string, session_id string, user_id string, event_type string,"
    " event_timestamp string, ingestion_timestamp string, page_url string,"
    " product_id int, category_name string, country_code string, device_type string,"
    " traffic_source string, event_position int, is_late_event boolean,"
    " original_event_id string"
)

BRONZE_EVENT_SCHEMA = schema_of(
    "kafka_key string, kafka_message_timestamp timestamp, event_id string, session_id string,"
    " user_id string, event_type string, event_timestamp timestamp,"
    " ingestion_timestamp timestamp, page_url string, product_id int, category_name string,"
    " country_code string, device_type string, traffic_source string, event_position int,"
    " is_late_event boolean, original_event_id string, bronze_ingested_at timestamp,"
    " partition_date string"
)

# Column order of the finished Silver events table.
SILVER_EVENT_SCHEMA = T.StructType(
    EVENTS.schema.fields[:-1]
    + schema_of(
        "session_event_count bigint, session_start_time timestamp, session_end_time timestamp,"
        " session_duration_seconds bigint, is_conversion boolean, partition_date string"
    ).fields
)
