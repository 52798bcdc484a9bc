"""End-to-end runs over a folder of tables. The only code that decides where data lies."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import changes_after
from tidemark.plans import gold
from tidemark.plans.ledger import Ledger
from tidemark.plans.silver import to_silver
from tidemark.quality import (
    Check,
    QualityReport,
    alert_rows,
    check_suite,
    failure_alert,
    report_of,
)
from tidemark.quality.suites import DAILY_SALES_SUITE, PRODUCT_FUNNEL_SUITE
from tidemark.session import exists, staging
from tidemark.sinks import (
    BATCH,
    CurrentTable,
    SumTable,
    append_counted,
    is_managed,
    land_batch,
    merge_landed,
    publish_slices,
    publish_table,
    read_landed_as_is,
    replace_slice,
)
from tidemark.sinks.current import SIGN
from tidemark.sources import (
    GOLD_VIEWS,
    parse_events,
    read_slices,
    read_table,
    with_audit,
    with_partition_date,
)
from tidemark.spec import (
    BRONZE_EVENT_SCHEMA,
    CUSTOMERS,
    ORDER_TABLES,
    ORDERS,
    SLICE,
    TableSpec,
    schema_of,
)
from tidemark.streaming import (
    ingest_available,
    read_silver_events,
    refresh_landed,
    refresh_silver_events,
)
from tidemark.streaming.ingest import landed_log


class NoNewData(RuntimeError):
    """A run that needs new input found none."""


@dataclass(frozen=True)
class Lake:
    """Table places below one root."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/orders/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/orders/{table}"

    def current(self, table: str) -> str:
        return f"{self.root}/current/orders/{table}"

    @property
    def bronze_events(self) -> str:
        return f"{self.root}/bronze/clickstream/events"

    @property
    def silver_events(self) -> str:
        return f"{self.root}/silver/clickstream/events"

    @property
    def gold_root(self) -> str:
        return f"{self.root}/gold"

    def gold(self, view: str) -> str:
        return f"{self.gold_root}/{GOLD_VIEWS[view]}"

    @property
    def order_days(self) -> str:
        return f"{self.root}/state/order_days"

    @property
    def ledger(self) -> str:
        return f"{self.root}/state/due"

    @property
    def watermarks(self) -> str:
        return f"{self.root}/state/watermarks"

    @property
    def events_checkpoint(self) -> str:
        return f"{self.root}/checkpoints/clickstream_bronze"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"


# Positions are kept as text: it survives any key type and time zone of the driver.
_STATE_SCHEMA = schema_of("position string, table_name string")


def load_watermarks(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Table name -> position of the last change taken in; one short row per table."""
    rows = read_table(spark, path, _STATE_SCHEMA).collect()
    return {row.table_name: json.loads(row.position) for row in rows}


def save_watermark(
    spark: SparkSession, path: str, table: str, position: Mapping[str, str]
) -> None:
    row = spark.createDataFrame([(json.dumps(dict(position)), table)], _STATE_SCHEMA)
    replace_slice(row, path, "table_name", table)


def ingest_changes(
    spark: SparkSession,
    lake: Lake,
    spec: TableSpec,
    source: DataFrame,
    limit: int | None = None,
    watermark: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """Land the next batch of changes of one table in Bronze, note its slices as due in Silver,
    then move the table's watermark.

    Count, touched dates and new position are observed while writing. The batch is named
    after the position it starts from: after a crash in between it is taken in again
    and replaces itself.
    """
    changes = changes_after(source, "updated_at", spec.key, watermark, limit)
    batch = with_partition_date(with_audit(changes, spec.name))
    order = ["updated_at", *spec.key]
    start = json.dumps(dict(watermark or {}), sort_keys=True)
    landed = land_batch(
        batch,
        lake.bronze(spec.name),
        f"c{zlib.crc32(start.encode()):08x}",
        SLICE,
        slices=F.collect_set(SLICE),
        top=F.max(F.struct(*order)).cast(
            T.StructType([T.StructField(c, T.StringType()) for c in order])
        ),
    )
    position = dict(watermark or {})
    if landed["rows"]:
        Ledger(spark, lake.ledger).note(f"silver-{spec.name}", landed["slices"])
        position = landed["top"].asDict()
        save_watermark(spark, lake.watermarks, spec.name, position)
    return {
        "table_name": spec.name,
        "rows_written": landed["rows"],
        "slices": sorted(landed["slices"]),
        "watermark": position,
    }


def run_cdc_cycle(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    limit: int | None = None,
    specs: Mapping[str, TableSpec] = ORDER_TABLES,
) -> dict[str, Any]:
    """One polling cycle over the given source tables."""
    watermarks = load_watermarks(spark, lake.watermarks)
    batches = [
        ingest_changes(spark, lake, specs[name], source, limit, watermarks.get(name))
        for name, source in sources.items()
    ]
    return {
        "tables_processed": len(batches),
        "total_rows_written": sum(b["rows_written"] for b in batches),
        "batches": batches,
    }


def build_silver_table(
    spark: SparkSession, lake: Lake, spec: TableSpec, days: Sequence[str]
) -> int:
    """Recompute Silver slices of one orders table from Bronze."""
    bronze = _bronze_slices(spark, lake.bronze(spec.name), spec, days)
    return publish_slices(to_silver(bronze, spec), lake.silver(spec.name), SLICE, days)


def _bronze_slices(
    spark: SparkSession, path: str, spec: TableSpec, days: Sequence[str]
) -> DataFrame:
    """Slices of a Bronze table in the types its source had."""
    if is_managed(spark, path):
        merged = read_landed_as_is(spark, path, days)
        return spark.createDataFrame([], spec.schema) if merged is None else merged.drop(BATCH)
    folders = [f"{path}/{SLICE}={day}" for day in days]
    there = [folder for folder in folders if exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], spec.schema)
    bronze = spark.read.option("basePath", path).parquet(*there).drop(BATCH)
    # Folder names that look like dates would be read as such.
    return bronze.withColumn(SLICE, F.col(SLICE).cast("string"))


def merge_bronze(
    spark: SparkSession, lake: Lake, days: Sequence[str] | None = None, **limits: int
) -> dict[str, dict[str, int]]:
    """Merge the batch folders of all Bronze tables, of some days or all, and of the log of
    landed events; see `merge_landed`. For a schedule of its own, beside landing and refreshes."""
    merged = {}
    for spec in ORDER_TABLES.values():
        if exists(spark, lake.bronze(spec.name)):
            merged[spec.name] = merge_landed(spark, lake.bronze(spec.name), SLICE, days, **limits)
    if exists(spark, lake.bronze_events):
        merged["events"] = merge_landed(spark, lake.bronze_events, SLICE, days, **limits)
        merged["events_log"] = merge_landed(spark, landed_log(lake.bronze_events), None, **limits)
    return merged


def current_table(spark: SparkSession, lake: Lake, spec: TableSpec) -> CurrentTable:
    # Only the totals per day follow a table's log, that of the orders.
    return CurrentTable.of(spark, lake.current(spec.name), spec, followed=spec.name == ORDERS.name)


def read_current(spark: SparkSession, lake: Lake, spec: TableSpec) -> DataFrame:
    """The stored latest version of every key."""
    return current_table(spark, lake, spec).read()


def advance_current(spark: SparkSession, lake: Lake, spec: TableSpec, days: Sequence[str]) -> bool:
    """Apply what the Silver slices ``days`` hold to the stored current table."""
    changes = read_slices(spark, lake.silver(spec.name), spec.schema, days)
    return current_table(spark, lake, spec).apply(changes)


ORDER_DAY_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.DateType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 2)),
        T.StructField("priced", T.LongType()),
        T.StructField("orders", T.LongType()),
    ]
)


def _order_days(spark: SparkSession, lake: Lake) -> SumTable:
    keys, sums = ("order_date", "customer_id"), ("revenue", "priced", "orders")
    return SumTable(spark, lake.order_days, keys, ORDER_DAY_SCHEMA, sums)


def read_order_days(spark: SparkSession, lake: Lake) -> DataFrame:
    """Sales per day and customer of the current orders (as `gold.sales_per_customer`)."""
    days = _order_days(spark, lake).read().filter("orders > 0")
    # A sum without a priced order is null, as it is over the orders themselves.
    return days.withColumn("revenue", F.when(F.col("priced") > 0, F.col("revenue")))


def advance_order_days(spark: SparkSession, lake: Lake) -> list[str]:
    """Bring the sales per day and customer up to the current orders, by their log alone: what
    replaced versions brought is taken off, what new ones bring is added.

    Notes the dates it touches as due in the daily sales, then commits. Its position in
    the log is part of the commit, so no version counts twice. Returns the dates.
    """
    orders, days = current_table(spark, lake, ORDERS), _order_days(spark, lake)
    upto = orders.version
    if upto <= days.position:
        return []
    log = orders.log(days.position)
    sign = F.col(SIGN)
    amount = F.when(sign > 0, F.col("total_amount")).otherwise(-F.col("total_amount"))
    delta = log.groupBy(F.to_date("order_timestamp").alias("order_date"), "customer_id").agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
        F.sum(F.when(F.col("total_amount").isNotNull(), sign).otherwise(0)).alias("priced"),
        F.sum(sign).alias("orders"),
    )
    with staging(delta, "order-days") as delta:
        found = delta.select(F.col("order_date").cast("string").alias("d")).distinct().collect()
        dates = sorted(row.d for row in found if row.d)
        Ledger(spark, lake.ledger).note("daily_sales", dates)
        days.add(delta, upto)
    orders.forget(upto)
    return dates


def build_silver_orders(
    spark: SparkSession,
    lake: Lake,
    days: Sequence[str],
    specs: Mapping[str, TableSpec] = ORDER_TABLES,
) -> dict[str, int]:
    return {name: build_silver_table(spark, lake, spec, days) for name, spec in specs.items()}


def build_silver_events(spark: SparkSession, lake: Lake, days: Sequence[str]) -> list[str]:
    return refresh_silver_events(spark, lake.bronze_events, lake.silver_events, days)


def _silver_events(spark: SparkSession, lake: Lake, days: Sequence[str]) -> DataFrame:
    return read_silver_events(spark, lake.silver_events, days)


def build_daily_sales(spark: SparkSession, lake: Lake, days: Sequence[str]) -> int:
    """Sales of some days, from the sales per day and customer; one job for all days."""
    wanted = read_order_days(spark, lake).filter(F.col("order_date").isin([date.fromisoformat(d) for d in days]))
    sales = gold.sales_by_country(wanted, read_current(spark, lake, CUSTOMERS))
    return publish_slices(sales, lake.gold("gold_daily_sales"), "order_date", days)


def build_customer_segments(spark: SparkSession, lake: Lake, snapshot_date: str) -> int:
    """Segments from the sales per day and customer; no order is read."""
    base = gold.rfm_of_days(read_order_days(spark, lake), snapshot_date)
    segments = gold.label_segments(gold.rfm_scores(base))
    path = lake.gold("gold_customer_segments")
    return publish_slices(segments, path, "snapshot_date", [snapshot_date])


def build_product_funnel(spark: SparkSession, lake: Lake, days: Sequence[str]) -> int:
    funnel = gold.product_funnel(_silver_events(spark, lake, days))
    return publish_slices(funnel, lake.gold("gold_product_funnel"), "event_date", days)


def build_hourly_traffic(spark: SparkSession, lake: Lake, days: Sequence[str]) -> int:
    traffic = gold.hourly_traffic(_silver_events(spark, lake, days))
    return publish_slices(traffic, lake.gold("gold_hourly_traffic"), "event_date", days)


def build_inventory_alerts(
    spark: SparkSession, lake: Lake, days: Sequence[str] | None = None, **thresholds: float
) -> int:
    """Alerts of some dates of the funnel, whose slices alone are read; by default of all
    dates, which replaces the whole table."""
    funnel, path = lake.gold("gold_product_funnel"), lake.gold("gold_inventory_alerts")
    if days is None:
        return publish_table(gold.inventory_alerts(read_table(spark, funnel), **thresholds), path, "event_date")
    schema = read_table(spark, funnel).schema
    alerts = gold.inventory_alerts(read_slices(spark, funnel, schema, days, "event_date"), **thresholds)
    return publish_slices(alerts, path, "event_date", days)


def check_gold_slice(
    spark: SparkSession,
    lake: Lake,
    view: str,
    column: str,
    day: str,
    checks: Sequence[Check],
) -> QualityReport:
    """Run a suite over one Gold slice and store an alert per failed check."""
    rows = read_table(spark, lake.gold(view)).filter(F.col(column) == F.lit(day).cast("date"))
    results = check_suite(rows, view, checks)
    verdicts = results.collect()
    report = report_of(view, verdicts)
    if not report.passed:
        failed = alert_rows(spark.createDataFrame(verdicts, results.schema))
        append_counted(failed, lake.alerts, None)
    return report


@contextmanager
def alert_on_failure(spark: SparkSession, lake: Lake, run_name: str) -> Iterator[None]:
    """Store a CRITICAL alert when the block fails, and let the error go on."""
    try:
        yield
    except Exception as error:
        alert = failure_alert(
            spark, run_name, f"{run_name} failed: {error}", payload={"run": run_name}
        )
        append_counted(alert, lake.alerts, None)
        raise


def _nothing(stage: str) -> None:
    pass


def run_orders(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    day: str,
    limit: int | None = None,
    gate: bool = True,
    after: Callable[[str], None] = _nothing,
) -> dict[str, Any]:
    """Ingest, Silver, current tables, sales and segments, quality gate for ``day``.

    Silver is refreshed for every slice that a batch touched, and sales for every order
    date that a new or replaced version of an order has, besides ``day``. What a stage has to
    do is noted until it is done (see `Ledger`), so a run that breaks off is made up for by the
    next one, for whatever day. ``after`` is told the name of every stage that ends. A customer's
    new country counts for the days that are built from then on.
    """
    ledger = Ledger(spark, lake.ledger)
    with alert_on_failure(spark, lake, "orders_pipeline"):
        ingested = run_cdc_cycle(spark, lake, sources, limit)
        after("ingest")
        silver = {}
        for spec in ORDER_TABLES.values():
            due = ledger.due(f"silver-{spec.name}")
            days = sorted({*due.slices, *([day] if spec.name in sources else [])})
            if days:
                silver[spec.name] = build_silver_table(spark, lake, spec, days)
                ledger.note(f"current-{spec.name}", days)
                ledger.done(f"silver-{spec.name}", due)
                after(f"silver-{spec.name}")
            due = ledger.due(f"current-{spec.name}")
            if due.slices:
                advance_current(spark, lake, spec, due.slices)
                ledger.done(f"current-{spec.name}", due)
                after(f"current-{spec.name}")
        advance_order_days(spark, lake)
        after("order_days")
        due = ledger.due("daily_sales")
        dates = sorted({day, *due.slices})
        sales = build_daily_sales(spark, lake, dates)
        ledger.done("daily_sales", due)
        after("daily_sales")
        marts = {"daily_sales": sales, "customer_segments": build_customer_segments(spark, lake, day)}
        after("customer_segments")
        report = check_gold_slice(
            spark, lake, "gold_daily_sales", "order_date", day, DAILY_SALES_SUITE
        )
        if gate:
            report.raise_if_failed()
    return {
        "ingest": ingested,
        "silver": silver,
        "days": dates,
        "gold": marts,
        "quality": report.summary(),
    }


def run_clickstream(
    spark: SparkSession,
    lake: Lake,
    messages: DataFrame,
    day: str,
    require_new: bool = True,
    gate: bool = True,
    after: Callable[[str], None] = _nothing,
) -> dict[str, Any]:
    """Ingest a stream of messages, Silver, funnel, traffic and alerts, quality gate for ``day``.

    All slices landed since the last run are brought up to date, besides ``day``; what a
    stage has to do is noted until it is done, as in `run_orders`.
    """
    ledger = Ledger(spark, lake.ledger)

    def touched(days: Sequence[str]) -> None:
        for mart in ("product_funnel", "hourly_traffic"):
            ledger.note(mart, days)

    with alert_on_failure(spark, lake, "clickstream_pipeline"):
        ingested = ingest_available(
            parse_events(messages), lake.bronze_events, lake.events_checkpoint
        )
        after("ingest")
        silver = refresh_landed(spark, lake.bronze_events, lake.silver_events, touched)
        after("silver")
        if require_new and not (ingested["rows_ingested"] or silver or ledger.due("product_funnel").slices):
            raise NoNewData("no new events to take in")
        marts = {}
        for mart, build in (("product_funnel", build_product_funnel), ("hourly_traffic", build_hourly_traffic)):
            due = ledger.due(mart)
            days = sorted({day, *due.slices})
            marts[mart] = build(spark, lake, days)
            if mart == "product_funnel":
                ledger.note("inventory_alerts", days)
            ledger.done(mart, due)
            after(mart)
        due = ledger.due("inventory_alerts")
        marts["inventory_alerts"] = build_inventory_alerts(spark, lake, due.slices)
        ledger.done("inventory_alerts", due)
        after("inventory_alerts")
        report = check_gold_slice(
            spark, lake, "gold_product_funnel", "event_date", day, PRODUCT_FUNNEL_SUITE
        )
        if gate:
            report.raise_if_failed()
    return {"ingest": ingested, "silver": silver, "gold": marts, "quality": report.summary()}


def quarantined_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """Bronze events without a readable event time; no Silver slice ever holds them."""
    return read_table(spark, lake.bronze_events, BRONZE_EVENT_SCHEMA).filter(
        F.col(SLICE).isNull()
    )
