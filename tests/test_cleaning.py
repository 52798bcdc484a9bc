from decimal import Decimal

import pytest

from tidemark.operators import drop_late, require_columns, standardise
from tidemark.plans.silver import to_silver
from tidemark.spec import CUSTOMERS, EVENTS, ORDERS, PRODUCTS, order_table

ORDER_COLUMNS = (
    "order_id bigint, order_external_id string, customer_id bigint, order_status string,"
    " order_timestamp string, total_amount double, currency_code string, created_at string,"
    " updated_at string, source_table string, ingested_at string, partition_date string"
)


def order(order_id=501, **other):
    """A row of a fictional stationery shop; any of its values can be given."""
    row = {
        "order_id": order_id,
        "external": f"st/{order_id}",
        "customer_id": 77,
        "status": "ON HOLD  ",
        "ordered": "2019-11-30 23:59:59.5",
        "amount": 0.125,
        "currency": "nok  ",
        "created": "2019-11-30 23:00:00",
        "updated": "2019-12-01 00:00:01",
        "source": "shop",
        "ingested": "2019-12-01 06:30:00",
        "day": "2019-12-01",
    }
    unknown = set(other) - set(row)
    assert not unknown, unknown
    return tuple({**row, **other}.values())


def only(frame, *rows):
    return standardise(frame(ORDER_COLUMNS, list(rows)), ORDERS).collect()


def test_text_is_trimmed_and_folded_and_amounts_are_rounded_half_up(frame):
    (row,) = only(frame, order())
    assert (row.order_status, row.currency_code) == ("on hold", "NOK")
    assert row.total_amount == Decimal("0.13")
    assert row.order_timestamp.microsecond == 500_000
    assert list(row.asDict()) == list(ORDERS.columns)


@pytest.mark.parametrize("column", ["ordered", "created"])
def test_an_unreadable_time_is_null_and_its_row_stays(frame, column):
    (row,) = only(frame, order(**{column: "30 Nov"}))
    name = {"ordered": "order_timestamp", "created": "created_at"}[column]
    assert row[name] is None and row.order_id == 501


def test_rows_without_required_values_are_dropped(frame):
    holes = [order(502, customer_id=None), order(None), order(503, status=None)]
    assert [r.order_id for r in only(frame, *holes, order(504))] == [504]


def test_missing_columns_are_named(frame):
    df = frame(ORDER_COLUMNS, [order()]).drop("currency_code", "ingested_at")
    with pytest.raises(ValueError, match=r"orders: missing columns \['currency_code', 'ingest"):
        standardise(df, ORDERS)
    assert require_columns(df, ["order_id"], "orders") is df


def test_silver_has_the_newest_version_of_each_slice(frame):
    df = frame(
        ORDER_COLUMNS,
        [
            order(7, status="b", updated="2019-12-01 09:00:00"),
            order(7, status="c", updated="2019-12-01 17:45:00"),
            order(7, status="a", updated="2019-12-01 08:00:00"),
            order(7, status="d", updated="2019-12-02 01:00:00", day="2019-12-02"),
            order(8, status="x"),
        ],
    )
    found = {(r.order_id, r.partition_date): r.order_status for r in to_silver(df, ORDERS).collect()}
    assert found == {(7, "2019-12-01"): "c", (7, "2019-12-02"): "d", (8, "2019-12-01"): "x"}


def test_customers_and_products(frame):
    audit = " created_at string, updated_at string, source_table string, ingested_at string,"
    customers = frame(
        "customer_id string, customer_external_id string, first_name string, last_name string,"
        f" email string, country_code string, city string,{audit} partition_date string",
        [("7", "c", " aDA ", "love lace", " A@B.C ", "pk ", " new york", "", "2026-03-08", "", "", "d")],
    )
    row = standardise(customers, CUSTOMERS).first()
    assert (row.customer_id, row.first_name, row.last_name) == (7, "Ada", "Love Lace")
    assert (row.email, row.country_code, row.city) == ("a@b.c", "PK", "New York")
    products = frame(
        "product_id string, product_sku string, product_name string, category_name string,"
        f" unit_price string, is_active string,{audit} partition_date string",
        [("x", " ab-1 ", " Pen ", " Office", "1.005", "true", "", "2026-03-08", "", "", "d")],
    )
    row = standardise(products, PRODUCTS).first()
    assert (row.product_id, row.product_sku, row.product_name) == (None, "AB-1", "Pen")
    assert (row.unit_price, row.is_active) == (Decimal("1.01"), True)


EVENT_COLUMNS = ", ".join(f"{c} string" for c in EVENTS.columns)


def event(**given):
    row = dict.fromkeys(EVENTS.columns, "?") | {
        "event_id": "E/9",
        "event_type": "CHECKOUT ",
        "event_timestamp": "2020-02-29T07:15:00+02:00",
        "ingestion_timestamp": "2020-02-29T05:15:20Z",
        "bronze_ingested_at": "2020-02-29 05:16:00",
        "product_id": "31",
        "is_late_event": "false",
        "partition_date": "2020-02-29",
    }
    return tuple({**row, **given}.values())


def test_events_lose_unreadable_required_values(frame):
    rows = [event(event_timestamp="noon"), event(), event(product_id="3l"), event(event_id=None)]
    kept = standardise(frame(EVENT_COLUMNS, rows), EVENTS).collect()
    assert sorted((r.event_id, r.product_id or 0) for r in kept) == [("E/9", 0), ("E/9", 31)]
    assert {r.event_type for r in kept} == {"checkout"} and kept[0].event_position is None
    assert {str(r.event_timestamp) for r in kept} == {"2020-02-29 05:15:00"}


def test_lateness_is_judged_to_the_microsecond(frame):
    taken = "2020-02-29 06:00:00"
    times = {
        "at the limit": "2020-02-29 05:50:00",
        "just over": "2020-02-29 05:49:59.999999",
        "ahead of its arrival": "2020-02-29 18:00:00",
        "the day before": "2020-02-28 06:00:00",
        "no time": None,
    }
    df = frame(
        "event_id string, event_timestamp timestamp, ingestion_timestamp timestamp",
        [(name, at, taken) for name, at in times.items()],
    )
    assert {r.event_id for r in drop_late(df).collect()} == {"at the limit", "ahead of its arrival"}
    assert drop_late(df, tolerance="1 day").count() == 4


def test_unknown_table():
    assert order_table("orders") is ORDERS
    with pytest.raises(ValueError, match="no such orders table"):
        order_table("refunds")
