from datetime import date
from decimal import Decimal
from itertools import product

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.functions import next_status
from tidemark.plans import gold, reports
from tidemark.sources import register_gold_views

EVENT = (
    "event_timestamp timestamp, product_id int, event_type string, session_id string,"
    " session_duration_seconds bigint, session_event_count bigint"
)


def events(frame, rows):
    return frame(EVENT, [(f"2026-03-08 {r[0]}", *r[1:]) for r in rows])


def test_funnel_rates(frame):
    kinds = {"page_view": 8, "product_click": 5, "add_to_cart": 4, "checkout": 3, "purchase": 1}
    rows = [("21:40:00", 6, kind, "s", 0, 1) for kind, n in kinds.items() for _ in range(n)]
    (row,) = gold.product_funnel(events(frame, rows)).collect()
    assert (row.event_date, row.product_id) == (date(2026, 3, 8), 6)
    assert (row.page_view_count, row.product_click_count, row.cart_count) == (8, 5, 4)
    assert (row.checkout_count, row.purchase_count) == (3, 1)
    assert (row.view_to_purchase_rate, row.cart_abandonment_rate) == (0.125, 0.75)


def test_funnel_without_views_or_product(frame):
    rows = [("10:00:00", 1, "purchase", "s", 0, 1), ("10:00:00", None, "page_view", "s", 0, 1)]
    (row,) = gold.product_funnel(events(frame, rows)).collect()
    assert (row.view_to_purchase_rate, row.cart_abandonment_rate) == (0.0, 0.0)
    more = [("10:00:00", 1, kind, "s", 0, 1) for kind in ("add_to_cart", "purchase", "purchase")]
    assert gold.product_funnel(events(frame, more)).first().cart_abandonment_rate == -1.0


def test_day_filter_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    events(frame, [("10:00:00", 1, "purchase", "s", 0, 1)]).write.parquet(path)
    df = gold.product_funnel(spark.read.parquet(path), "2026-03-08")
    plan = plan_of(df)
    assert df.count() == 1 and "GreaterThanOrEqual(event_timestamp" in plan
    assert "session_id" not in plan
    assert gold.product_funnel(spark.read.parquet(path), "2026-03-09").count() == 0


def test_alert_thresholds_are_exclusive(frame):
    rates, carts = (0.59, 0.6, 0.61, 0.8, 0.81), (10, 11)
    rows = [(100 * c + int(100 * r), c, r) for r in rates for c in carts]
    funnel = frame("product_id bigint, cart_count bigint, cart_abandonment_rate double", rows)
    found = {r.product_id: r.severity for r in gold.inventory_alerts(funnel).collect()}
    assert found == {1161: "MEDIUM", 1180: "MEDIUM", 1181: "HIGH"}
    assert gold.inventory_alerts(funnel, min_rate=0.6, min_carts=9).count() == 6


def test_a_missing_score_meets_no_threshold(spark):
    schema = "recency_score int, frequency_score int, monetary_score int"
    rows = [(None, 4, 4), (4, None, 4), (4, 4, None), (None, None, None), (2, 3, None)]
    labels = [r.segment_label for r in gold.label_segments(spark.createDataFrame(rows, schema)).collect()]
    assert labels == ["New_Customer", "New_Customer", "Loyal", "New_Customer", "At_Risk"]


def test_types_of_the_marts(spark):
    from tidemark.plans.catalogue import _customers, _funnel, _orders
    from tidemark.plans.silver import timely_events
    from tidemark.sources import testdata as td

    sf = "/root/testdata/sf0.001"
    kinds = lambda df: dict(df.dtypes)
    sales = kinds(gold.daily_sales(_orders(spark, sf), _customers(spark, sf)))
    assert (sales["order_date"], sales["total_revenue"]) == ("date", "decimal(25,2)")
    assert sales["order_count"] == sales["unique_customers"] == "bigint"
    base = kinds(gold.rfm_base(_orders(spark, sf), "2001-09-01"))
    assert (base["monetary"], base["last_order_date"], base["recency_days"]) == ("decimal(25,2)", "date", "int")
    funnel = kinds(_funnel(spark, sf))
    assert (funnel["event_date"], funnel["cart_abandonment_rate"]) == ("date", "double")
    traffic = kinds(gold.hourly_traffic(timely_events(td.bronze_events(spark, sf))))
    assert (traffic["event_date"], traffic["event_hour"], traffic["bounce_rate"]) == ("date", "int", "double")


def test_traffic_of_all_days_is_that_of_each_day(frame):
    times = ["2026-03-08 23:50:00", "2026-03-09 00:10:00", "2026-03-09 00:20:00"]
    df = frame(
        "event_timestamp timestamp, event_type string, session_id string",
        [(t, k, "night") for t, k in zip(times, ["view", "purchase", "view"], strict=True)],
    )
    together = sorted(map(tuple, gold.hourly_traffic(df).collect()))
    apart = [r for day in ("2026-03-08", "2026-03-09") for r in gold.hourly_traffic(df, day).collect()]
    assert together == sorted(map(tuple, apart)) and len(together) == 2
    assert [(r[1], r[3], r[4], r[6]) for r in together] == [
        (23, 0, 0.0, 1.0),
        (0, 1, 600.0, 0.0),
    ]


def expected_label(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 3:
        return "Loyal"
    if f >= 3:
        return "At_Risk"
    return "Lost" if r == 1 else "New_Customer"


def test_labels_of_all_scores(spark):
    scores = list(product(range(1, 6), repeat=3))
    df = spark.createDataFrame(
        scores, "recency_score int, frequency_score int, monetary_score int"
    )
    for row in gold.label_segments(df).collect():
        assert row.segment_label == expected_label(*row[:3])


def test_rfm(frame):
    orders = frame(
        "order_id bigint, customer_id bigint, order_timestamp timestamp, total_amount decimal(14,2)",
        [
            (1, 1, "2026-03-01 10:00:00", "10.10"),
            (2, 1, "2026-03-05 23:59:59", "20.20"),
            (3, 2, "2026-02-01 00:00:00", "5.00"),
        ],
    )
    base = {r.customer_id: r for r in gold.rfm_base(orders, "2026-03-08").collect()}
    assert (base[1].recency_days, base[1].frequency, base[1].monetary) == (3, 2, Decimal("30.30"))
    assert base[2].recency_days == 35 and base[2].snapshot_date == date(2026, 3, 8)
    scores = {r.customer_id: r for r in gold.rfm_scores(gold.rfm_base(orders, "2026-03-08")).collect()}
    assert scores[1].recency_score > scores[2].recency_score
    assert scores[1].frequency_score > scores[2].frequency_score


def test_daily_sales(frame):
    orders = frame(
        "order_id bigint, customer_id bigint, order_timestamp timestamp, total_amount decimal(14,2)",
        [
            (1, 1, "2026-03-08 10:00:00", "10.00"),
            (2, 1, "2026-03-08 11:00:00", "10.01"),
            (3, 2, "2026-03-08 12:00:00", None),
            (4, 9, "2026-03-08 12:00:00", "1.00"),
            (5, 2, "2026-03-09 12:00:00", "7.00"),
        ],
    )
    customers = frame("customer_id bigint, country_code string", [(1, "PK"), (2, "PK")])
    rows = {
        (str(r.order_date), r.country): tuple(r)[2:]
        for r in gold.daily_sales(orders, customers).collect()
    }
    assert rows == {
        ("2026-03-08", "PK"): (Decimal("20.01"), 3, Decimal("10.01"), 2),
        ("2026-03-08", None): (Decimal("1.00"), 1, Decimal("1.00"), 1),
        ("2026-03-09", "PK"): (Decimal("7.00"), 1, Decimal("7.00"), 1),
    }
    assert gold.daily_sales(orders, customers, "2026-03-09").count() == 1


def test_traffic_counts_sessions_at_their_start(frame):
    df = events(
        frame,
        [
            ("10:10:00", 1, "page_view", "a", 4000, 2),
            ("11:16:40", 1, "purchase", "a", 4000, 2),
            ("10:59:00", 1, "page_view", "b", 0, 1),
            ("12:00:00", 1, "purchase", "c", 0, 1),
        ],
    )
    rows = {r.event_hour: r for r in gold.hourly_traffic(df).collect()}
    # No session starts at 11.
    assert set(rows) == {10, 12}
    assert (rows[10].active_users, rows[10].purchases, rows[10].total_events) == (2, 1, 2)
    assert (rows[10].avg_session_duration, rows[10].bounce_rate) == (2000.0, 0.5)
    assert (rows[12].purchases, rows[12].bounce_rate) == (1, 1.0)


def test_traffic_reads_the_events_once(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    events(frame, [("10:00:00", 1, "purchase", "s", 0, 1)]).write.parquet(path)
    plan = plan_of(gold.hourly_traffic(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1 and "Join" not in plan


FUNNEL = (
    "event_day string, product_id int, page_view_count bigint, product_click_count bigint,"
    " cart_count bigint, checkout_count bigint, purchase_count bigint,"
    " view_to_purchase_rate double, cart_abandonment_rate double"
)


@pytest.fixture
def funnel(frame):
    rows = [
        ("2026-03-07", 9, 100, 1, 90, 1, 80, 0.8, 0.1111),
        ("2026-03-08", 1, 10, 5, 4, 3, 2, 0.2, 0.5),
        ("2026-03-09", 1, 10, 5, 4, 3, 1, 0.1, 0.75),
        ("2026-03-09", 2, 3, 0, 4, 0, 3, 1.0, 0.25),
        ("2026-03-10", 3, 3, 0, 0, 0, 0, 0.0, 0.0),
    ]
    day = F.col("event_day").cast("date")
    return frame(FUNNEL, rows).withColumn("event_date", day).drop("event_day")


RANGE = ("2026-03-08", "2026-03-10")


def test_top_products(funnel):
    rows = reports.top_revenue_products(funnel, *RANGE, top_n=2).collect()
    # Product 1 has more carts at the same number of purchases.
    assert [(r.product_id, r.purchases, r.carts) for r in rows] == [(1, 3, 8), (2, 3, 4)]
    assert rows[0].avg_view_to_purchase_rate == 0.15
    assert rows[0].avg_cart_abandonment_rate == 0.625


def test_conversion_funnel(funnel):
    row = reports.conversion_funnel(funnel, *RANGE).first()
    assert (row.total_page_views, row.total_add_to_cart, row.total_purchases) == (26, 12, 6)
    assert row.overall_view_to_purchase_rate == 0.2308
    assert row.overall_cart_abandonment_rate == 0.5
    (none,) = reports.conversion_funnel(funnel, "2027-01-01", "2027-01-02").collect()
    assert none.total_page_views is None and none.overall_cart_abandonment_rate == 0.0


def test_cart_abandonment(funnel):
    rows = reports.cart_abandonment(funnel, *RANGE).collect()
    assert [(r.product_id, r.cart_abandonment_rate) for r in rows] == [(1, 0.625), (2, 0.25)]


def test_segment_report(frame):
    segments = frame(
        "day string, segment_label string, recency_days int, frequency bigint, monetary decimal(14,2)",
        [("2026-03-08", label, r, 1, "1.50") for label, r in [("B", 1), ("A", 2), ("C", 3), ("C", 4)]]
        + [("2026-03-07", "A", 1, 1, "1.00")],
    ).withColumn("snapshot_date", F.col("day").cast("date"))
    rows = reports.customer_segments(segments, "2026-03-08").collect()
    assert [(r.segment_label, r.customer_count) for r in rows] == [("C", 2), ("A", 1), ("B", 1)]
    assert rows[0].avg_recency_days == 3.5 and rows[0].avg_monetary == Decimal("1.50")


def test_views_of_the_tables_that_exist(spark, funnel, tmp_path):
    root = str(tmp_path)
    funnel.write.parquet(f"{root}/funnel/product_funnel")
    assert register_gold_views(spark, root) == ["gold_product_funnel"]
    total = spark.sql(
        "SELECT sum(cart_count) AS n FROM gold_product_funnel WHERE event_date >= :d",
        args={"d": date(2026, 3, 8)},
    )
    assert total.first().n == 12


def test_order_status_flow(frame):
    df = frame("s string", [("pending",), ("processing",), ("shipped",), ("delivered",), ("x",), (None,)])
    steps = [r.n for r in df.select(next_status(F.col("s")).alias("n")).collect()]
    assert steps == ["processing", "shipped", "delivered", None, None, None]
