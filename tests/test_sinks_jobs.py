import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.quality import QualityError
from tidemark.sinks import append_counted, append_observed, replace_slice, replace_slices, replace_table
from tidemark.sources import read_slice, read_table, register_gold_views
from tidemark.sources import testdata as td
from tidemark.spec import EVENTS, ORDERS, SILVER_EVENT_SCHEMA, schema_of
from tidemark.streaming import read_silver_events

SF = "/root/testdata/sf0.001"
SLICED = schema_of("id bigint, day string")


def content(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, SLICED).collect())


def test_append(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame("id bigint, day string", [(1, "a"), (2, "b"), (3, None)])
    assert append_counted(df, path, "day") == 3
    seen = append_observed(df, path, "day", top=F.max("id"), days=F.collect_set("day"))
    assert (seen["rows"], seen["top"], sorted(seen["days"])) == (3, 3, ["a", "b"])
    assert read_table(spark, path, SLICED).count() == 6
    assert append_counted(df.limit(0), path, "day") == 0


def test_replacing_a_slice_twice_is_replacing_it_once(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    old = frame("id bigint, day string", [(1, "a"), (2, "b")])
    new = frame("id bigint, day string", [(3, "a"), (4, "a")])
    assert replace_slices(old, path, "day", ["a", "b"]) == 2
    for _ in range(2):
        assert replace_slice(new, path, "day", "a") == 2
        assert content(spark, path) == [(2, "b"), (3, "a"), (4, "a")]
    assert replace_slice(new.limit(0), path, "day", "a") == 0
    assert content(spark, path) == [(2, "b")]
    assert replace_slices(new, path, "day", []) == 0
    with_gap = frame("id bigint, day string", [(5, "a"), (6, "c")])
    assert replace_slices(with_gap, path, "day", ["a", "b", "c"]) == 2
    assert content(spark, path) == [(5, "a"), (6, "c")]


@pytest.mark.parametrize("stray", ["c", None])
def test_rows_outside_the_slice_leave_the_table_alone(frame, spark, tmp_path, stray):
    path = str(tmp_path / "t")
    replace_slice(frame("id bigint, day string", [(1, "a")]), path, "day", "a")
    bad = frame("id bigint, day string", [(2, "a"), (3, stray)])
    with pytest.raises(Exception, match="not among the slices"):
        replace_slice(bad, path, "day", "a")
    assert content(spark, path) == [(1, "a")]


def test_full_replace(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame("id bigint, day string", [(1, "a"), (2, "b")])
    assert (replace_table(df, path), replace_table(df.limit(1), path)) == (2, 1)
    assert spark.read.parquet(path).count() == 1


def test_slice_scan_prunes_and_tolerates_what_is_missing(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_slice(spark, path, SLICED, "a", "day").count() == 0
    append_counted(frame("id bigint, day string", [(1, "a"), (2, "b")]), path, "day")
    one = read_slice(spark, path, SLICED, "a", "day")
    assert [tuple(r) for r in one.collect()] == [(1, "a")]
    assert [f.rsplit("/", 2)[1] for f in one.inputFiles()] == ["day=a"]
    assert read_slice(spark, path, SLICED, "z", "day").count() == 0


# --- jobs ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sources(spark):
    audit = ("source_table", "ingested_at", "partition_date")
    tables = {
        "customers": td.customers(spark, SF),
        "products": td.products(spark, SF),
        "orders": td.orders(spark, SF),
        "order_items": td.order_items(spark, SF),
    }
    # A few weeks of orders: every day of a feed is a slice to write.
    recent = F.col("order_timestamp") >= "2001-07-10"
    tables["orders"] = tables["orders"].filter(recent)
    return {name: df.drop(*audit) for name, df in tables.items()}


def test_change_feed_cycles(spark, sources, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    feed = {"orders": sources["orders"]}
    total = feed["orders"].count()
    written = []
    while not written or written[-1]:
        cycle = jobs.run_cdc_cycle(spark, lake, feed, limit=17)
        written.append(cycle["total_rows_written"])
    assert sum(written) == total and max(written) == 17
    bronze = spark.read.parquet(lake.bronze("orders"))
    assert bronze.select("order_id", "updated_at").distinct().count() == bronze.count() == total
    assert set(jobs.load_watermarks(spark, lake.watermarks)) == {"orders"}


def test_orders_run(spark, sources, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    latest = sources["orders"].agg(F.max(F.to_date("order_timestamp"))).first()[0]
    day = str(latest)
    feed = {name: df for name, df in sources.items() if name != "order_items"}
    # Few customers of one day: those without an address leave the country empty.
    passing = {**feed, "customers": feed["customers"].withColumn("email", F.lit("a@b"))}
    result = jobs.run_orders(spark, lake, passing, day)
    assert result["quality"]["passed"] and result["gold"]["daily_sales"] > 0
    silver = read_table(spark, lake.silver("orders"), ORDERS.schema)
    assert result["silver"]["orders"] == silver.count()
    current = jobs.read_current(spark, lake, ORDERS)
    assert current.count() == current.select("order_id").distinct().count() == silver.select("order_id").distinct().count()
    assert result["gold"]["customer_segments"] == silver.select("customer_id").distinct().count()
    # Nothing new: the same tables again.
    again = jobs.run_orders(spark, lake, passing, day)
    assert again["ingest"]["total_rows_written"] == 0 and again["days"] == [day]
    assert again["gold"]["customer_segments"] == result["gold"]["customer_segments"]
    assert register_gold_views(spark, lake.gold_root) == ["gold_daily_sales", "gold_customer_segments"]
    assert not os.path.exists(lake.alerts)


def test_failed_gate_leaves_alerts(spark, sources, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    feed = {name: sources[name] for name in ("customers", "orders")}
    with pytest.raises(QualityError, match="gold_daily_sales has 0 rows"):
        jobs.run_orders(spark, lake, feed, "1990-01-01")
    alerts = spark.read.parquet(lake.alerts).collect()
    assert sorted(a.alert_type for a in alerts) == [
        "check_duplicate_rate",
        "check_null_rate",
        "check_row_count",
        "pipeline_failure",
    ]
    failed = next(a for a in alerts if a.alert_type == "pipeline_failure")
    assert failed.severity == "CRITICAL" and json.loads(failed.alert_payload)["run"]


def test_silver_tables_of_several_days(spark, sources, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    cycle = jobs.run_cdc_cycle(spark, lake, {"products": sources["products"]})
    days = cycle["batches"][0]["slices"]
    rows = jobs.build_silver_orders(
        spark, lake, days, {"products": jobs.ORDER_TABLES["products"]}
    )
    assert rows["products"] == sources["products"].count()


def test_clickstream_run(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    landing = str(tmp_path / "topic")
    day = "2024-01-15"
    messages = td.messages(td.table(spark, SF, "events"))
    messages.write.parquet(landing)

    def topic():
        return spark.readStream.schema(messages.schema).parquet(landing)

    result = jobs.run_clickstream(spark, lake, topic(), day)
    assert result["ingest"]["rows_ingested"] == messages.count() and result["quality"]["passed"]
    silver = read_silver_events(spark, lake.silver_events)
    assert silver.select("partition_date").distinct().count() > 20
    assert silver.select("event_id").distinct().count() == silver.count() > 0
    assert set(register_gold_views(spark, lake.gold_root)) == {
        "gold_product_funnel",
        "gold_hourly_traffic",
        "gold_inventory_alerts",
    }
    traffic = spark.table("gold_hourly_traffic").agg(F.sum("active_users")).first()[0]
    assert traffic == silver.select("session_id", "partition_date").distinct().count()
    with pytest.raises(jobs.NoNewData):
        jobs.run_clickstream(spark, lake, topic(), day)
    (alert,) = spark.read.parquet(lake.alerts).collect()
    assert alert.alert_type == "pipeline_failure" and "no new events" in alert.alert_message
    again = jobs.run_clickstream(spark, lake, topic(), day, require_new=False)
    assert again["gold"]["inventory_alerts"] == result["gold"]["inventory_alerts"]
    assert 0 < again["gold"]["product_funnel"] < result["gold"]["product_funnel"]
    assert jobs.quarantined_events(spark, lake).count() == 0
    assert set(EVENTS.columns) <= set(SILVER_EVENT_SCHEMA.names)


def test_late_changes_reach_the_days_they_belong_to(spark, frame, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    columns = (
        "order_id bigint, order_external_id string, customer_id bigint, order_status string,"
        " order_timestamp timestamp, total_amount double, currency_code string,"
        " created_at timestamp, updated_at timestamp"
    )

    def order(i, day, amount, updated):
        return (i, f"o{i}", 5, "new", f"2021-06-0{day} 12:00:00", amount, "eur", f"2021-06-0{day}", updated)

    def run(rows, day):
        return jobs.run_orders(spark, lake, {"orders": frame(columns, rows)}, f"2021-06-0{day}", gate=False)

    def sales():
        stored = read_table(spark, lake.gold("gold_daily_sales")).collect()
        return {str(r.order_date): (float(r.total_revenue), r.order_count) for r in stored}

    first = [order(1, 1, 10.0, "2021-06-01 13:00:00"), order(2, 1, 3.0, "2021-06-01 14:00:00")]
    run(first, 1)
    assert sales() == {"2021-06-01": (13.0, 2)}
    late = [
        order(1, 1, 99.0, "2021-06-02 09:00:00"),
        order(3, 1, 5.0, "2021-06-02 10:00:00"),
        order(4, 2, 1.0, "2021-06-02 11:00:00"),
        order(2, 2, 3.0, "2021-06-02 12:00:00"),  # its order time was wrong
    ]
    assert run([*first, *late], 2)["days"] == ["2021-06-01", "2021-06-02"]
    assert sales() == {"2021-06-01": (104.0, 2), "2021-06-02": (4.0, 2)}


def test_staged_folders_can_be_cleared(spark, frame):
    from tidemark.session import clear_staged, shared_folder, staged

    clear_staged(spark)
    df = staged(frame("id bigint, day string", [(1, "a")]), "probe")
    assert df.count() == 1 and clear_staged(spark) == 1 and clear_staged(spark) == 0
    assert not [p for p in os.listdir(f"{shared_folder(spark)}/tidemark") if p.startswith("probe")]
