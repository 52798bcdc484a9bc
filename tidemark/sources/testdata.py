"""The bundled test tables, seen as the orders and clickstream domains.

Every function is one pass over its table (plus joins to the nation and region
dimensions), so the domain tables grow with the input. Text is padded and mixed in
case, some keys come in several versions, and some events arrive twice or late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import utc_date
from tidemark.sources.tables import with_audit, with_partition_date
from tidemark.spec import EVENT_SCHEMA, ORDER_ITEMS, schema_of

# Copies of one order line share their timestamps; the rest of the row decides.
TESTDATA_ORDER_ITEMS = ORDER_ITEMS.with_tiebreak(
    ("product_id", "desc"), ("unit_price", "desc"), ("quantity", "desc")
)


# Given, so that planning a query does not start with a job that looks into the files.
TABLES = {
    "region": schema_of("r_regionkey int, r_name string"),
    "nation": schema_of("n_nationkey int, n_name string, n_regionkey int"),
    "customer": schema_of(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": schema_of(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": schema_of(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": schema_of(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": schema_of(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _versions(is_repeated: Column) -> Column:
    """0 for every row, and 1 as well for rows that come in a second version."""
    both, one = F.array(F.lit(0), F.lit(1)), F.array(F.lit(0))
    return F.explode(F.when(is_repeated, both).otherwise(one)).alias("v")


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(mins=count.cast("int"))


def _taken_in(df: DataFrame, name: str) -> DataFrame:
    """Audit columns with a fixed delay in place of the clock, so results repeat."""
    ingested_at = F.col("updated_at") + F.expr("INTERVAL 5 MINUTES")
    return with_partition_date(with_audit(df, name, ingested_at))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "customer").select("*", _versions(F.col("c_custkey") % 7 == 0))
    start = F.lit("2000-01-01").cast("timestamp")
    return _taken_in(
        rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit("cx-"), F.col("c_custkey")).alias("customer_external_id"),
            F.lit("  customer ").alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            # Indebted customers lack an address and are malformed.
            F.when(
                F.col("c_acctbal") >= 0,
                F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")),
            ).alias("email"),
            F.lower("n_name").alias("country_code"),
            F.when(F.col("v") == 0, F.concat(F.lit(" "), F.col("r_name")))
            .otherwise(F.col("n_name"))
            .alias("city"),
            start.alias("created_at"),
            (start + _minutes(F.col("c_custkey") % 1440 + F.col("v"))).alias("updated_at"),
        ),
        "customers",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2000-01-01").cast("timestamp")
    return _taken_in(
        table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit(" sku-"), F.col("p_partkey")).alias("product_sku"),
            F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product_name"),
            F.concat(F.col("p_type"), F.lit("  ")).alias("category_name"),
            F.col("p_retailprice").alias("unit_price"),
            F.when(F.col("p_size") <= 40, F.lit("true")).otherwise(F.lit("no")).alias("is_active"),
            start.alias("created_at"),
            (start + _minutes(F.col("p_partkey") % 1440)).alias("updated_at"),
        ),
        "products",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed: every fifth one has an update a day later."""
    ordered_at = F.col("o_orderdate").cast("timestamp")
    status = F.when(F.col("v") == 1, F.col("second")).otherwise(F.col("first"))
    return _taken_in(
        table(spark, sf_dir, "orders")
        .select("*", _versions(F.col("o_orderkey") % 5 == 0))
        .withColumns(
            {
                "first": F.expr(
                    "CASE o_orderstatus WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Processing'"
                    " ELSE 'Delivered' END"
                ),
                "second": F.expr(
                    "CASE o_orderstatus WHEN 'O' THEN 'Processing' WHEN 'P' THEN 'Shipped'"
                    " ELSE 'Delivered' END"
                ),
            }
        )
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.concat(F.lit("ox-"), F.col("o_orderkey")).alias("order_external_id"),
            F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit(" "), status).alias("order_status"),
            ordered_at.alias("order_timestamp"),
            F.col("o_totalprice").alias("total_amount"),
            F.lit(" usd ").alias("currency_code"),
            ordered_at.alias("created_at"),
            (
                ordered_at + _minutes(F.col("o_orderkey") % 1440 + F.col("v") * 1440)
            ).alias("updated_at"),
        ),
        "orders",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped_at = F.col("l_shipdate").cast("timestamp")
    quantity = F.col("l_quantity").cast("int")
    # Divided as decimals: halves of a cent round the same way everywhere.
    unit_price = (F.col("l_extendedprice").cast("decimal(12,2)") / quantity).cast("decimal(12,2)")
    return _taken_in(
        table(spark, sf_dir, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            unit_price.alias("unit_price"),
            (quantity * unit_price).cast("decimal(14,2)").alias("line_amount"),
            shipped_at.alias("created_at"),
            shipped_at.alias("updated_at"),
        ),
        "order_items",
    )


def events(events_table: DataFrame) -> DataFrame:
    """Typed clickstream events; every 33rd is sent twice, every 50th arrives late."""
    ts = F.col("ts").cast("timestamp")
    is_late = F.col("event_id") % 50 == 0
    k = F.get_json_object("props", "$.k").cast("int")
    delay = F.make_dt_interval(
        mins=F.when(is_late, F.lit(15)).otherwise(F.lit(1)), secs=F.col("v") * F.lit(30)
    )
    event_type = F.expr(
        "CASE event_type WHEN 'view' THEN 'Page_View' WHEN 'click' THEN 'product_click'"
        " WHEN 'signup' THEN 'add_to_cart ' WHEN 'error' THEN 'checkout' ELSE event_type END"
    )
    device = F.expr(
        "CASE event_id % 3 WHEN 0 THEN ' Mobile' WHEN 1 THEN 'DESKTOP' ELSE 'tablet' END"
    )
    source = F.expr("CASE user_id % 2 WHEN 0 THEN 'Organic ' ELSE 'paid' END")
    return events_table.select("*", _versions(F.col("event_id") % 33 == 0)).select(
        F.col("event_id").cast("string").alias("event_id"),
        # A user's session lasts from six to six, so it crosses midnight.
        F.concat(
            F.col("user_id"),
            F.lit("-"),
            F.replace(utc_date(ts - F.expr("INTERVAL 6 HOURS")), F.lit("-"), F.lit("")),
        ).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        event_type.alias("event_type"),
        ts.alias("event_timestamp"),
        (ts + delay).alias("ingestion_timestamp"),
        F.concat(F.lit("/p/"), k.cast("string")).alias("page_url"),
        (k % 10).alias("product_id"),
        F.concat(F.lit("category "), (k % 5).cast("string")).alias("category_name"),
        F.concat(F.lit(" n"), (F.col("user_id") % 25).cast("string")).alias("country_code"),
        device.alias("device_type"),
        source.alias("traffic_source"),
        (F.col("event_id") % 5 + 1).cast("int").alias("event_position"),
        is_late.alias("is_late_event"),
        F.when(F.col("v") == 1, F.col("event_id").cast("string")).alias("original_event_id"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they lie in Bronze, taken in one minute after they arrived."""
    rows = events(table(spark, sf_dir, "events")).withColumn(
        "bronze_ingested_at", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 MINUTE")
    )
    return with_partition_date(rows, "event_timestamp")


def messages(events_table: DataFrame) -> DataFrame:
    """Events as a topic would deliver them: JSON payload with ISO-8601 times."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    rows = events(events_table)
    payload = F.struct(
        *[
            F.date_format(c, iso).alias(c) if c.endswith("_timestamp") else F.col(c)
            for c in EVENT_SCHEMA.names
        ]
    )
    return rows.select(
        F.col("session_id").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.col("ingestion_timestamp").alias("timestamp"),
    )
