"""SQL for the catalogue's queries, to check them against another engine (DuckDB).

Written from the definitions, not from the Spark plans: window functions and
self-joins where the library aggregates, integer arithmetic where it rounds.
"""

from __future__ import annotations

import re

from tidemark.plans.catalogue import (
    AS_OF,
    BATCH_ROWS,
    EVENT_DAY,
    FEED_SPLIT,
    ORDER_DAY,
    RANGE,
    SEASON_DAYS,
    SEASON_START,
    SNAPSHOT_DATE,
)

FROM_TO = f"event_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of two integers rounded half away from zero, as a double."""
    n, d, scale = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**digits
    rounded = f"((2 * {scale} * abs({n}) + {d}) // (2 * {d}))"
    return f"(sign({n}) * CAST({rounded} AS DOUBLE) / {scale}.0)"


def decimal_mean(cents: str, count: str, kind: str) -> str:
    """Mean of money: to six decimals first, then to two."""
    n, d = f"CAST({cents} AS HUGEINT)", f"CAST({count} AS HUGEINT)"
    micros = f"((2 * {n} * 10000 + {d}) // (2 * {d}))"
    return f"CAST((({micros}) + 5000) // 10000 / 100.0 AS {kind})"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def audited(name: str) -> str:
    return (
        f"'{name}' AS source_table, updated_at + INTERVAL 5 MINUTE AS ingested_at,"
        " strftime(updated_at, '%Y-%m-%d') AS partition_date"
    )


def versions(table: str, repeated: str) -> str:
    return f"(SELECT *, unnest(CASE WHEN {repeated} THEN [0, 1] ELSE [0] END) AS v FROM {table})"


def one_by(keys: str, order: str, source: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM {source} QUALIFY row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


def title(text: str) -> str:
    words = f"string_split(lower(trim({text})), ' ')"
    capital = "lambda w: concat(upper(w[1:1]), w[2:])"
    return f"array_to_string(list_transform({words}, {capital}), ' ')"


LATEST = "updated_at DESC, ingested_at DESC"
AUDIT = "created_at, updated_at, source_table, ingested_at, partition_date"

TABLES = {
    "customers_feed": f"""
        SELECT *, {audited("customers")} FROM (
          SELECT c_custkey AS customer_id, concat('cx-', c_custkey) AS customer_external_id,
            '  customer ' AS first_name, split_part(c_name, '#', 2) AS last_name,
            CASE WHEN c_acctbal >= 0 THEN concat(' ', upper(c_name), '@EXAMPLE.COM ') END AS email,
            lower(n_name) AS country_code,
            CASE WHEN v = 0 THEN concat(' ', r_name) ELSE n_name END AS city,
            TIMESTAMP '2000-01-01' AS created_at,
            TIMESTAMP '2000-01-01' + to_minutes(c_custkey % 1440 + v) AS updated_at
          FROM {versions("customer", "c_custkey % 7 = 0")} c
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "customers_std": f"""
        SELECT customer_id, customer_external_id, {title("first_name")} AS first_name,
          {title("last_name")} AS last_name, lower(trim(email)) AS email,
          upper(trim(country_code)) AS country_code, {title("city")} AS city, {AUDIT}
        FROM customers_feed WHERE email IS NOT NULL""",
    "customers_now": one_by("customer_id", LATEST, "customers_std"),
    "products_feed": f"""
        SELECT *, {audited("products")} FROM (
          SELECT p_partkey AS product_id, concat(' sku-', p_partkey) AS product_sku,
            concat(' ', p_name, ' ') AS product_name, concat(p_type, '  ') AS category_name,
            p_retailprice AS unit_price, p_size <= 40 AS is_active,
            TIMESTAMP '2000-01-01' AS created_at,
            TIMESTAMP '2000-01-01' + to_minutes(p_partkey % 1440) AS updated_at
          FROM part)""",
    "products_std": f"""
        SELECT product_id, upper(trim(product_sku)) AS product_sku,
          trim(product_name) AS product_name, trim(category_name) AS category_name,
          CAST(unit_price AS DECIMAL(12, 2)) AS unit_price, is_active, {AUDIT}
        FROM products_feed""",
    "orders_feed": f"""
        SELECT *, {audited("orders")} FROM (
          SELECT o_orderkey AS order_id, concat('ox-', o_orderkey) AS order_external_id,
            o_custkey AS customer_id,
            concat(' ', CASE WHEN o_orderstatus = 'F' THEN 'Delivered'
                 WHEN o_orderstatus = 'O' THEN CASE v WHEN 0 THEN 'Pending' ELSE 'Processing' END
                 ELSE CASE v WHEN 0 THEN 'Processing' ELSE 'Shipped' END END) AS order_status,
            o_orderdate AS order_timestamp, o_totalprice AS total_amount,
            ' usd ' AS currency_code, o_orderdate AS created_at,
            o_orderdate + to_minutes(o_orderkey % 1440 + v * 1440) AS updated_at
          FROM {versions("orders", "o_orderkey % 5 = 0")})""",
    "orders_std": f"""
        SELECT order_id, order_external_id, customer_id, lower(trim(order_status)) AS order_status,
          order_timestamp, CAST(total_amount AS DECIMAL(14, 2)) AS total_amount,
          upper(trim(currency_code)) AS currency_code, {AUDIT}
        FROM orders_feed""",
    "orders_now": one_by("order_id", LATEST, "orders_std"),
    "items_std": f"""
        SELECT order_item_id, order_id, product_id, quantity, unit_price,
          CAST(quantity * unit_price AS DECIMAL(14, 2)) AS line_amount, created_at, updated_at,
          {audited("order_items")}
        FROM (SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
            l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
            CAST({half_up("round(l_extendedprice * 100)", "l_quantity", 0)} / 100.0
              AS DECIMAL(12, 2)) AS unit_price,
            l_shipdate AS created_at, l_shipdate AS updated_at
          FROM lineitem)""",
    "events_sent": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
          concat(user_id, '-', strftime(ts - INTERVAL 6 HOUR, '%Y%m%d')) AS session_id,
          CAST(user_id AS VARCHAR) AS user_id,
          CASE event_type WHEN 'view' THEN 'Page_View' WHEN 'click' THEN 'product_click'
            WHEN 'signup' THEN 'add_to_cart ' WHEN 'error' THEN 'checkout'
            ELSE event_type END AS event_type,
          ts AS event_timestamp,
          ts + to_seconds(CASE WHEN event_id % 50 = 0 THEN 900 ELSE 60 END + v * 30)
            AS ingestion_timestamp,
          concat('/p/', k) AS page_url, CAST(k % 10 AS INTEGER) AS product_id,
          concat('category ', k % 5) AS category_name,
          concat(' n', user_id % 25) AS country_code,
          CASE event_id % 3 WHEN 0 THEN ' Mobile' WHEN 1 THEN 'DESKTOP' ELSE 'tablet' END
            AS device_type,
          CASE user_id % 2 WHEN 0 THEN 'Organic ' ELSE 'paid' END AS traffic_source,
          CAST(event_id % 5 + 1 AS INTEGER) AS event_position, event_id % 50 = 0 AS is_late_event,
          CASE WHEN v = 1 THEN CAST(event_id AS VARCHAR) END AS original_event_id,
          strftime(ts, '%Y-%m-%d') AS partition_date
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM {versions("events", "event_id % 33 = 0")})""",
    "events_std": """
        SELECT event_id, session_id, user_id, lower(trim(event_type)) AS event_type,
          event_timestamp, ingestion_timestamp,
          ingestion_timestamp + INTERVAL 1 MINUTE AS bronze_ingested_at, page_url, product_id,
          category_name, upper(trim(country_code)) AS country_code,
          lower(trim(device_type)) AS device_type, lower(trim(traffic_source)) AS traffic_source,
          event_position, is_late_event, original_event_id, partition_date
        FROM events_sent""",
    "events_once": one_by(
        "event_id, partition_date", "ingestion_timestamp, bronze_ingested_at", "events_std"
    ),
    "events_timely": """
        SELECT * FROM events_once
        WHERE event_timestamp >= ingestion_timestamp - INTERVAL 10 MINUTE""",
    "events_silver": """
        SELECT * EXCLUDE (partition_date, starts, ends),
          starts AS session_start_time, ends AS session_end_time,
          epoch_us(ends) // 1000000 - epoch_us(starts) // 1000000 AS session_duration_seconds,
          partition_date
        FROM (SELECT *, count(*) OVER w AS session_event_count,
            min(event_timestamp) OVER w AS starts, max(event_timestamp) OVER w AS ends,
            bool_or(event_type = 'purchase') OVER w AS is_conversion
          FROM events_timely WINDOW w AS (PARTITION BY session_id, partition_date))""",
    "sales": f"""
        SELECT CAST(order_timestamp AS DATE) AS order_date, country_code AS country,
          CAST(sum(total_amount) AS DECIMAL(25, 2)) AS total_revenue,
          count(DISTINCT order_id) AS order_count,
          {decimal_mean(cents("sum(total_amount)"), "count(*)", "DECIMAL(19, 2)")}
            AS avg_order_value,
          count(DISTINCT customer_id) AS unique_customers
        FROM orders_now LEFT JOIN customers_now USING (customer_id) GROUP BY 1, 2""",
    "funnel": """
        SELECT *,
          CASE WHEN page_view_count > 0 THEN CAST(purchase_count AS DOUBLE) / page_view_count
            ELSE 0.0::DOUBLE END AS view_to_purchase_rate,
          CASE WHEN cart_count > 0 THEN CAST(cart_count - purchase_count AS DOUBLE) / cart_count
            ELSE 0.0::DOUBLE END AS cart_abandonment_rate
        FROM (SELECT CAST(event_timestamp AS DATE) AS event_date, product_id,
            count(*) FILTER (event_type = 'page_view') AS page_view_count,
            count(*) FILTER (event_type = 'product_click') AS product_click_count,
            count(*) FILTER (event_type = 'add_to_cart') AS cart_count,
            count(*) FILTER (event_type = 'checkout') AS checkout_count,
            count(*) FILTER (event_type = 'purchase') AS purchase_count
          FROM events_timely WHERE product_id IS NOT NULL GROUP BY 1, 2)""",
    "traffic": f"""
        SELECT s.event_date, s.event_hour, active_users, purchases, avg_session_duration,
          total_events, CAST(bounces AS DOUBLE) / active_users AS bounce_rate
        FROM (SELECT CAST(starts AS DATE) AS event_date, CAST(hour(starts) AS INTEGER) AS event_hour,
            count(*) AS active_users,
            count(*) FILTER (bought) AS purchases, count(*) FILTER (n = 1) AS bounces,
            {half_up("sum(secs)", "count(*)", 2)} AS avg_session_duration
          FROM (SELECT session_id, min(event_timestamp) AS starts,
              max(session_duration_seconds) AS secs, min(session_event_count) AS n,
              bool_or(event_type = 'purchase') AS bought
            FROM events_silver GROUP BY session_id, partition_date) GROUP BY 1, 2) s
        LEFT JOIN (SELECT CAST(event_timestamp AS DATE) AS event_date,
            CAST(hour(event_timestamp) AS INTEGER) AS event_hour, count(*) AS total_events
          FROM events_silver GROUP BY 1, 2) e USING (event_date, event_hour)""",
    "rfm": f"""
        SELECT *, DATE '{SNAPSHOT_DATE}' AS snapshot_date,
          CAST(date_diff('day', last_order_date, DATE '{SNAPSHOT_DATE}') AS INTEGER) AS recency_days
        FROM (SELECT customer_id, max(CAST(order_timestamp AS DATE)) AS last_order_date,
            count(DISTINCT order_id) AS frequency,
            CAST(sum(total_amount) AS DECIMAL(25, 2)) AS monetary
          FROM orders_now GROUP BY 1)""",
    "scores": """
        SELECT *,
          CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS recency_score,
          CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS frequency_score,
          CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS monetary_score
        FROM rfm""",
    "segments": """
        SELECT *, CASE
          WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
          WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal'
          WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At_Risk'
          WHEN recency_score = 1 AND frequency_score <= 2 THEN 'Lost'
          ELSE 'New_Customer' END AS segment_label
        FROM scores""",
}


# The orders of all years moved into one season, and what is built from them.
_SEASON = f"{SEASON_DAYS} * 86400000000"
_START = f"epoch_us(TIMESTAMP '{SEASON_START}')"
_SEASON_TIME = f"make_timestamp((epoch_us(order_timestamp) - {_START}) % ({_SEASON}) + {_START})"
TABLES["season_now"] = f"""
    SELECT * EXCLUDE (moved) REPLACE (moved AS order_timestamp, moved AS created_at,
        moved + (updated_at - order_timestamp) AS updated_at,
        strftime(moved + (updated_at - order_timestamp), '%Y-%m-%d') AS partition_date)
    FROM (SELECT *, {_SEASON_TIME} AS moved FROM orders_now)"""
for _name, _of in (
    ("sales", "orders_now"),
    ("rfm", "orders_now"),
    ("scores", "rfm"),
    ("segments", "scores"),
):
    _from = "season_now" if _of == "orders_now" else f"season_{_of}"
    TABLES[f"season_{_name}"] = re.sub(rf"\b{_of}\b", _from, TABLES[_name])


def _with_tables(select: str) -> str:
    """Put the tables a select needs in front of it, each after those it needs itself."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n]})" for n in needed) + " " + select


def check_row(
    number: int,
    name: str,
    table: str,
    source: str,
    metric: str,
    threshold: float,
    passed: str,
    message: str,
) -> str:
    return f"""
        SELECT {number} AS check_no, 'check_{name}' AS check_name, {passed} AS passed,
          CAST({metric} AS DOUBLE) AS metric_value, CAST(NULL AS VARCHAR) AS metric_note,
          CAST({threshold} AS DOUBLE) AS threshold_value, {message} AS message,
          '{table}' AS table_name
        FROM {source}"""


def rate_check(
    number: int, name: str, table: str, source: str, part: str, limit: float, what: str
) -> str:
    inner = f"(SELECT count(*) AS n, {part} AS part FROM {source})"
    return check_row(
        number,
        name,
        table,
        inner,
        half_up("part", "n", 6),
        limit,
        f"part / n <= {limit}",
        f"printf('{what} is %.6f, at most {limit:.6f} allowed', CAST(part AS DOUBLE) / n)",
    )


def null_check(number: int, table: str, source: str, column: str, limit: float = 0.0) -> str:
    part = f"count(*) FILTER ({column} IS NULL)"
    what = f"null rate of {column}"
    return rate_check(number, "null_rate", table, source, part, limit, what)


def duplicate_check(
    number: int, table: str, source: str, keys: tuple[str, ...], limit: float = 0.0
) -> str:
    row = ", ".join(f"{k} := {k}" for k in keys)
    part = f"count(*) - count(DISTINCT struct_pack({row}))"
    what = f"duplicate rate on {', '.join(keys)}"
    return rate_check(number, "duplicate_rate", table, source, part, limit, what)


def violation_check(
    number: int, name: str, table: str, source: str, condition: str, what: str
) -> str:
    return check_row(
        number,
        name,
        table,
        f"(SELECT count(*) FILTER ({condition}) AS n FROM {source})",
        "n",
        0,
        "n = 0",
        f"concat(n, ' rows {what}')",
    )


def range_check(
    number: int,
    table: str,
    source: str,
    column: str,
    low: float | int | None,
    high: float | int | None = None,
) -> str:
    limits = [f"{column} < {low}" if low is not None else "false"]
    limits += [f"{column} > {high}" if high is not None else "false"]
    what = f"with {column} outside [{low}, {high}]"
    return violation_check(number, "value_range", table, source, " OR ".join(limits), what)


def foreign_key_check(
    number: int, table: str, source: str, column: str, parent: str, parent_column: str
) -> str:
    condition = (
        f"{column} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    )
    return check_row(
        number,
        "referential_integrity",
        table,
        f"(SELECT count(*) AS n FROM {source} c WHERE {condition})",
        "n",
        0,
        "n = 0",
        f"concat(n, ' rows with {column} missing from parent column {parent_column}')",
    )


def row_count_check(number: int, table: str, source: str, least: int) -> str:
    return check_row(
        number,
        "row_count",
        table,
        f"(SELECT count(*) AS n FROM {source})",
        "n",
        least,
        f"n >= {least}",
        f"concat('{table} has ', n, ' rows, at least {least} expected')",
    )


def freshness_check(number: int, table: str, source: str, column: str, limit: int) -> str:
    return check_row(
        number,
        "freshness",
        table,
        f"(SELECT epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max({column})) AS us FROM {source})",
        half_up("us", "60000000", 2),
        limit,
        f"us <= {limit * 60_000_000}",
        f"printf('newest {column} is %.2f minutes old, at most {limit} allowed',"
        " CAST(us AS DOUBLE) / 60000000)",
    )


SALES_SUITE = [
    row_count_check(1, "gold_daily_sales", "sales", 1),
    null_check(2, "gold_daily_sales", "sales", "country", 0.2),
    duplicate_check(3, "gold_daily_sales", "sales", ("order_date", "country")),
    range_check(4, "gold_daily_sales", "sales", "total_revenue", 0, 1_000_000_000),
]
FUNNEL_SUITE = [
    row_count_check(1, "gold_product_funnel", "funnel", 1),
    null_check(2, "gold_product_funnel", "funnel", "product_id"),
    duplicate_check(3, "gold_product_funnel", "funnel", ("event_date", "product_id")),
    range_check(4, "gold_product_funnel", "funnel", "cart_abandonment_rate", 0, 1),
    range_check(5, "gold_product_funnel", "funnel", "view_to_purchase_rate", 0, 1),
]


def union(checks: list[str]) -> str:
    return " UNION ALL ".join(checks)


DAY_FUNNEL = f"(SELECT * FROM funnel WHERE event_date = DATE '{EVENT_DAY}')"
DAY_SUITE = [
    row_count_check(1, "gold_product_funnel", DAY_FUNNEL, 1),
    null_check(2, "gold_product_funnel", DAY_FUNNEL, "product_id"),
    duplicate_check(3, "gold_product_funnel", DAY_FUNNEL, ("event_date", "product_id")),
    range_check(4, "gold_product_funnel", DAY_FUNNEL, "cart_abandonment_rate", 0, 1),
    range_check(5, "gold_product_funnel", DAY_FUNNEL, "view_to_purchase_rate", 0, 1),
]
DOMAIN = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
STORED_ALERTS = f"""(
    SELECT 'quality_runner' AS alert_source, check_name AS alert_type, unnest(CASE WHEN
      check_name = 'check_value_range' THEN ['HIGH', 'AWFUL'] ELSE ['HIGH'] END) AS severity, message AS alert_message
    FROM ({union(FUNNEL_SUITE)}) WHERE NOT passed)"""
ALERT_CHECKS = [
    *[
        null_check(k, "alerts", STORED_ALERTS, c)
        for k, c in enumerate(("alert_source", "alert_type", "severity", "alert_message"), start=1)
    ],
    violation_check(
        5,
        "allowed_values",
        "alerts",
        STORED_ALERTS,
        f"severity NOT IN {DOMAIN}",
        f"with severity not in {', '.join(DOMAIN)}",
    ),
]


def constraint_checks() -> list[str]:
    sources = {
        "customers": "customers_now",
        "products": "products_std",
        "orders": "orders_now",
        "order_items": "items_std",
    }
    unique = {
        "customers": ("customer_id", "email"),
        "products": ("product_id", "product_sku"),
        "orders": ("order_id",),
        "order_items": ("order_item_id",),
    }
    not_null = {
        "customers": "customer_id customer_external_id first_name last_name email country_code city",
        "products": "product_id product_sku product_name category_name unit_price is_active",
        "orders": "order_id order_external_id customer_id order_status order_timestamp"
        " total_amount currency_code",
        "order_items": "order_item_id order_id product_id quantity unit_price",
    }
    at_least = {
        "customers": {},
        "products": {"unit_price": 0},
        "orders": {"total_amount": 0},
        "order_items": {"quantity": 1, "unit_price": 0},
    }
    parents = {
        "customers": {},
        "products": {},
        "orders": {"customer_id": "customers_now"},
        "order_items": {"order_id": "orders_now", "product_id": "products_std"},
    }
    checks = []
    for table, source in sources.items():
        number = 0
        for column in unique[table]:
            checks.append(duplicate_check(number := number + 1, table, source, (column,)))
        for column in (*not_null[table].split(), "created_at", "updated_at"):
            checks.append(null_check(number := number + 1, table, source, column))
        for column, low in at_least[table].items():
            checks.append(range_check(number := number + 1, table, source, column, low))
        for column, parent in parents[table].items():
            number += 1
            checks.append(foreign_key_check(number, table, source, column, parent, column))
    return checks


def mean_rate(column: str) -> str:
    total = f"sum(CAST(round({column} * 1000000000000) AS HUGEINT))"
    return half_up(total, "count(*) * 1000000000000", 4)


def total_rate(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {half_up(part, whole, 4)} ELSE 0.0::DOUBLE END"


CARTS, PURCHASES, VIEWS = "sum(cart_count)", "sum(purchase_count)", "sum(page_view_count)"


def alerts(rate: float, carts: int, high: float) -> str:
    return f"""
        SELECT *, CASE WHEN cart_abandonment_rate > {high}::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END
          AS severity
        FROM funnel WHERE cart_abandonment_rate > {rate}::DOUBLE AND cart_count > {carts}"""


LANDED = "session_id AS kafka_key, ingestion_timestamp AS kafka_message_timestamp, *"

_SQL = {
    "bronze_parse_events": f"SELECT {LANDED} FROM events_sent",
    "cdc_batch_orders": f"""
        SELECT order_id, order_status, updated_at, partition_date FROM orders_feed
        WHERE updated_at > TIMESTAMP '{FEED_SPLIT}'
          OR (updated_at = TIMESTAMP '{FEED_SPLIT}' AND order_id > 0)
        ORDER BY updated_at, order_id LIMIT {BATCH_ROWS}""",
    "cdc_high_watermark": """
        SELECT updated_at, order_id FROM orders_feed
        ORDER BY updated_at DESC, order_id DESC LIMIT 1""",
    "cdc_watermark_fallback": """
        SELECT updated_at, order_id FROM orders_feed
        ORDER BY updated_at DESC, order_id DESC LIMIT 1""",
    "cdc_apply_changes": "SELECT * FROM orders_now",
    "silver_customers": one_by("customer_id, partition_date", LATEST, "customers_std"),
    "silver_products": one_by("product_id, partition_date", LATEST, "products_std"),
    "silver_orders": one_by("order_id, partition_date", LATEST, "orders_std"),
    "silver_order_items": one_by(
        "order_item_id, partition_date",
        f"{LATEST}, product_id DESC, unit_price DESC, quantity DESC",
        "items_std",
    ),
    "silver_current_orders": "SELECT * FROM orders_now",
    "silver_events_dedup": "SELECT * FROM events_once",
    "silver_events_late": "SELECT * FROM events_timely",
    "silver_sessions": """
        SELECT event_id, session_id, count(*) OVER w AS session_event_count,
          min(event_timestamp) OVER w AS session_start_time,
          max(event_timestamp) OVER w AS session_end_time,
          epoch_us(max(event_timestamp) OVER w) // 1000000
            - epoch_us(min(event_timestamp) OVER w) // 1000000 AS session_duration_seconds,
          bool_or(event_type = 'purchase') OVER w AS is_conversion
        FROM events_timely WINDOW w AS (PARTITION BY session_id, partition_date)""",
    "silver_events": "SELECT * FROM events_silver",
    "gold_daily_sales": "SELECT * FROM sales",
    "gold_daily_sales_day": f"SELECT * FROM sales WHERE order_date = DATE '{ORDER_DAY}'",
    "gold_product_funnel": "SELECT * FROM funnel",
    "gold_product_funnel_day": f"SELECT * FROM funnel WHERE event_date = DATE '{EVENT_DAY}'",
    "gold_hourly_traffic": "SELECT * FROM traffic",
    "gold_rfm_base": "SELECT * FROM rfm",
    "gold_rfm_scores": "SELECT * FROM scores",
    "gold_customer_segments": "SELECT * FROM segments",
    "gold_inventory_alerts": alerts(0.6, 10, 0.8),
    "gold_inventory_alerts_low": alerts(0.1, 2, 0.4),
    "report_top_products": f"""
        SELECT product_id, CAST({PURCHASES} AS BIGINT) AS purchases,
          CAST({CARTS} AS BIGINT) AS carts,
          {mean_rate("view_to_purchase_rate")} AS avg_view_to_purchase_rate,
          {mean_rate("cart_abandonment_rate")} AS avg_cart_abandonment_rate
        FROM funnel WHERE {FROM_TO} GROUP BY 1
        ORDER BY purchases DESC, carts DESC, product_id LIMIT 5""",
    "report_conversion_funnel": f"""
        SELECT CAST({VIEWS} AS BIGINT) AS total_page_views,
          CAST(sum(product_click_count) AS BIGINT) AS total_product_clicks,
          CAST({CARTS} AS BIGINT) AS total_add_to_cart,
          CAST(sum(checkout_count) AS BIGINT) AS total_checkouts,
          CAST({PURCHASES} AS BIGINT) AS total_purchases,
          {total_rate(PURCHASES, VIEWS)} AS overall_view_to_purchase_rate,
          {total_rate(f"({CARTS} - {PURCHASES})", CARTS)} AS overall_cart_abandonment_rate
        FROM funnel WHERE {FROM_TO}""",
    "report_hourly_traffic": f"""
        SELECT event_date, event_hour, active_users, total_events,
          {half_up("CAST(round(bounce_rate * active_users) AS BIGINT)", "active_users", 4)}
            AS bounce_rate, purchases, avg_session_duration
        FROM traffic WHERE event_date = DATE '{EVENT_DAY}'""",
    "report_segments": f"""
        SELECT snapshot_date, segment_label, count(*) AS customer_count,
          {half_up("sum(recency_days)", "count(*)", 2)} AS avg_recency_days,
          {half_up("sum(frequency)", "count(*)", 2)} AS avg_frequency,
          {decimal_mean(cents("sum(monetary)"), "count(*)", "DECIMAL(25, 2)")} AS avg_monetary
        FROM segments GROUP BY 1, 2""",
    "report_cart_abandonment": f"""
        SELECT product_id, CAST({CARTS} AS BIGINT) AS total_cart_count,
          CAST({PURCHASES} AS BIGINT) AS total_purchase_count,
          {total_rate(f"({CARTS} - {PURCHASES})", CARTS)} AS cart_abandonment_rate
        FROM funnel WHERE {FROM_TO} GROUP BY 1 HAVING {CARTS} > 0""",
    "dq_null_rate": null_check(1, "customers", "customers_feed", "email", 0.05),
    "dq_duplicate_rate": duplicate_check(
        1, "order_items", "items_std", ("order_item_id", "updated_at")
    ),
    "dq_row_count": row_count_check(1, "events", "events_sent", 1000),
    "dq_value_range": range_check(1, "orders", "orders_feed", "total_amount", 1000, 400_000),
    "dq_freshness": union(
        [
            freshness_check(1, "events", "events_sent", "event_timestamp", 30),
            freshness_check(2, "events", "events_sent", "ingestion_timestamp", 100_000),
        ]
    ),
    "dq_referential_integrity": foreign_key_check(
        1, "orders", "orders_feed", "customer_id", "customers_now", "customer_id"
    ),
    "dq_suite_orders": union(SALES_SUITE),
    "dq_suite_events": union(FUNNEL_SUITE),
    "dq_dictionary_suite": union(FUNNEL_SUITE),
    "dq_gate_raises": f"""
        SELECT 'gold_product_funnel' AS table_name,
          concat('gold_product_funnel: ', string_agg(message, '; ' ORDER BY check_no)) AS error
        FROM ({union(FUNNEL_SUITE)}) WHERE NOT passed""",
    "dq_alert_constraints": union(ALERT_CHECKS),
    "schema_refused": """
        SELECT c AS missing, concat('events: missing columns [', chr(39), c, chr(39), ']') AS error,
          (SELECT count(*) FROM events_sent) AS bronze_rows
        FROM (VALUES ('event_id'), ('page_url')) t(c)""",
    "dq_constraints": union(constraint_checks()),
    "dq_alert_rows": f"""
        SELECT 'quality_runner' AS alert_source, check_name AS alert_type, 'HIGH' AS severity,
          table_name, 'data_quality' AS pipeline_name, message AS alert_message,
          TIMESTAMP '{AS_OF}' AS event_timestamp, CAST(NULL AS TIMESTAMP) AS resolved_at,
          TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
        FROM ({union(FUNNEL_SUITE)}) WHERE NOT passed""",
    "order_line_amount": """
        SELECT order_item_id, product_id, quantity, unit_price, line_amount FROM items_std""",
    "order_totals_rollup": """
        SELECT order_id, CAST(sum(line_amount) AS DECIMAL(14, 2)) AS total_amount,
          count(*) AS item_count
        FROM items_std GROUP BY 1""",
    "order_next_status": """
        SELECT order_id, order_status, CASE order_status WHEN 'pending' THEN 'processing'
          WHEN 'processing' THEN 'shipped' WHEN 'shipped' THEN 'delivered' END AS next_status
        FROM orders_now""",
    "ingest_profile_events": """
        SELECT count(*) AS event_count, count(original_event_id) AS duplicate_count,
          count(*) FILTER (is_late_event) AS late_event_count
        FROM events_sent""",
    "sink_replace_slice": "SELECT * FROM funnel",
    "sink_merged_landing": """
        SELECT stage, partition_date, events, ids FROM (
          SELECT partition_date, count(*) AS events, count(DISTINCT event_id) AS ids FROM events_sent GROUP BY 1
        ), (SELECT unnest(['landed', 'merged', 'again', 'merged again']) AS stage)""",
    "stream_ingest": f"SELECT {LANDED} FROM events_sent",
    "stream_dedup": """
        SELECT DISTINCT event_id, session_id, user_id, event_timestamp, product_id, partition_date
        FROM events_sent""",
    "stream_dedup_indexed": """
        SELECT DISTINCT event_id, session_id, user_id, event_timestamp, product_id, partition_date
        FROM events_sent""",
    "stream_continuous": f"SELECT {LANDED} FROM events_sent",
    "stream_timely": """
        SELECT event_id, event_type, event_timestamp, ingestion_timestamp, country_code,
          partition_date
        FROM events_std WHERE event_timestamp >= ingestion_timestamp - INTERVAL 10 MINUTE""",
    "stream_silver_slices": "SELECT * EXCLUDE (bronze_ingested_at) FROM events_silver",
    "job_change_feed": "SELECT * EXCLUDE (ingested_at) FROM ("
    + one_by("customer_id, partition_date", LATEST, "customers_std")
    + ")",
    "stream_mixed_landing": "SELECT partition_date, event_id, count(*) AS n FROM events_sent GROUP BY 1, 2",
    "current_orders": "SELECT * EXCLUDE (ingested_at) FROM season_now",
    "job_orders_run": "SELECT * FROM season_sales",
    "gold_slice_report": f"""
        SELECT check_name, passed, metric_value, message, CAST(CASE WHEN passed THEN 0 ELSE 1 END AS BIGINT) AS alerts
        FROM ({union(DAY_SUITE)})""",
    "job_alerts_by_day": alerts(0.1, 2, 0.4),
    "job_orders_recovered": "SELECT * FROM season_sales",
    "job_order_days": """
        SELECT CAST(order_timestamp AS DATE) AS order_date, customer_id, sum(total_amount) AS revenue,
          count(order_id) AS orders FROM season_now GROUP BY 1, 2""",
    "job_segments": "SELECT * FROM season_segments",
    "job_clickstream_run": "SELECT * FROM traffic",
    "job_funnel_alerts": alerts(0.1, 2, 0.4),
    "report_from_views": f"""
        SELECT product_id, CAST({PURCHASES} AS BIGINT) AS purchases,
          CAST({CARTS} AS BIGINT) AS carts,
          {mean_rate("view_to_purchase_rate")} AS avg_view_to_purchase_rate,
          {mean_rate("cart_abandonment_rate")} AS avg_cart_abandonment_rate
        FROM funnel WHERE {FROM_TO} GROUP BY 1
        ORDER BY purchases DESC, carts DESC, product_id LIMIT 5""",
    "dq_alert_sink": f"""
        SELECT check_name AS alert_type, table_name, message AS alert_message,
          message AS payload_message, CAST(threshold_value AS VARCHAR) AS payload_threshold
        FROM ({union(FUNNEL_SUITE)}) WHERE NOT passed""",
    "dq_failure_alert": """
        SELECT 'CRITICAL' AS severity, 'pipeline_failure' AS alert_type,
          concat('orders_pipeline failed: gold_daily_sales: ', string_agg(message, '; ' ORDER BY k)) AS alert_message
        FROM (
          SELECT count(*) AS n FROM season_sales WHERE order_date = DATE '2030-01-01'
        ), (VALUES (1, 'gold_daily_sales has 0 rows, at least 1 expected'),
          (2, 'gold_daily_sales is empty, no null rate of country'),
          (3, 'gold_daily_sales is empty, no duplicate rate on order_date, country')) said(k, message)
        WHERE n = 0""",
    "dq_report": f"""
        SELECT table_name, bool_and(passed) AS passed, count(*) AS total_checks,
          count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks
        FROM ({union(FUNNEL_SUITE)}) GROUP BY 1""",
    "job_clickstream_day": f"SELECT * FROM traffic WHERE event_date = DATE '{EVENT_DAY}'",
}


# Columns the catalogue shows as text (dates) and as doubles (money).
_DATES = {"order_date", "event_date", "last_order_date", "snapshot_date"}
_MONEY = {
    "revenue",
    "avg_monetary",
    "avg_order_value",
    "line_amount",
    "monetary",
    "total_amount",
    "total_revenue",
    "unit_price",
}
_RFM = ("last_order_date", "monetary", "snapshot_date")
_SALES = ("avg_order_value", "order_date", "total_revenue")
_SHOWN = {
    "cdc_apply_changes": ("total_amount",),
    "silver_products": ("unit_price",),
    "silver_orders": ("total_amount",),
    "silver_order_items": ("line_amount", "unit_price"),
    "silver_current_orders": ("total_amount",),
    "gold_daily_sales": _SALES,
    "gold_daily_sales_day": _SALES,
    "gold_product_funnel": ("event_date",),
    "gold_product_funnel_day": ("event_date",),
    "gold_hourly_traffic": ("event_date",),
    "gold_rfm_base": _RFM,
    "gold_rfm_scores": _RFM,
    "gold_customer_segments": _RFM,
    "gold_inventory_alerts": ("event_date",),
    "gold_inventory_alerts_low": ("event_date",),
    "report_hourly_traffic": ("event_date",),
    "report_segments": ("avg_monetary", "snapshot_date"),
    "order_line_amount": ("line_amount", "unit_price"),
    "order_totals_rollup": ("total_amount",),
    "sink_replace_slice": ("event_date",),
    "job_clickstream_day": ("event_date",),
    "job_clickstream_run": ("event_date",),
    "job_funnel_alerts": ("event_date",),
    "job_alerts_by_day": ("event_date",),
    "job_orders_run": _SALES,
    "job_orders_recovered": _SALES,
    "job_order_days": ("order_date", "revenue"),
    "job_segments": _RFM,
    "current_orders": ("total_amount",),
}


def _shown(name: str, select: str) -> str:
    kinds = {**dict.fromkeys(_DATES, "VARCHAR"), **dict.fromkeys(_MONEY, "DOUBLE")}
    casts = ", ".join(f"CAST({c} AS {kinds[c]}) AS {c}" for c in _SHOWN.get(name, ()))
    return f"SELECT * REPLACE ({casts}) FROM ({select})" if casts else select


def all_sql() -> dict[str, str]:
    return {name: _with_tables(_shown(name, select)) for name, select in _SQL.items()}
