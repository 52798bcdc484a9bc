import json

import duckdb
import pytest
from compare import differences
from conftest import plan_of

from tidemark.plans.catalogue import all_queries
from tidemark.plans.oracle import all_sql
from tidemark.quality import (
    ALERT_SCHEMA,
    AllowedValues,
    DuplicateRate,
    ForeignKey,
    Freshness,
    NullRate,
    QualityError,
    RowCount,
    ValueRange,
    alert_rows,
    check_from_config,
    check_suite,
    failure_alert,
    run_suite,
)
from tidemark.quality.suites import (
    ALERTS_SUITE,
    DAILY_SALES_SUITE,
    PRODUCT_FUNNEL_SUITE,
    constraint_suites,
)

COLUMNS = "reading int, station string, celsius double"
CHECKS = [RowCount(3), NullRate("station"), DuplicateRate(("reading",)), ValueRange("celsius", -40, 50)]


@pytest.fixture(scope="module")
def clean(frame):
    return frame(COLUMNS, [(71, "harbour", -40.0), (72, "hill", 50.0), (73, "hill", 11.5)])


@pytest.fixture(scope="module")
def bad(frame):
    return frame(COLUMNS, [(74, None, 51.0), (74, "hill", -40.5), (74, None, 50.5), (75, "hill", 0.0)])


def metrics(report):
    return [(r.passed, r.metric_value) for r in report.results]


def test_clean_data_passes(clean):
    report = run_suite(clean, "clean", CHECKS)
    assert metrics(report) == [(True, 3), (True, 0), (True, 0), (True, 0)]
    assert report.passed and report.raise_if_failed() is report
    assert report.summary()["passed_checks"] == 4


def test_bad_data_fails(bad):
    report = run_suite(bad, "bad", [RowCount(5), *CHECKS[1:]])
    assert metrics(report) == [(False, 4), (False, 0.5), (False, 0.5), (False, 3)]
    with pytest.raises(QualityError, match="bad: bad has 4 rows, at least 5 expected"):
        report.raise_if_failed()


def test_empty_table(clean):
    report = run_suite(clean.limit(0), "none", [*CHECKS, Freshness("station", 5)])
    assert [r.passed for r in report.results] == [False, False, False, True, False]
    assert report.results[1].metric_value == "empty_dataframe"
    assert report.results[2].metric_value == "empty_dataframe"
    assert report.results[4].metric_value == "null_max_timestamp"


def test_rates_are_compared_unrounded_and_null_keys_count_once(frame):
    df = frame("a int, b int", [(None, 1), (None, 1), (1, None), (1, 2)])
    report = run_suite(df, "t", [DuplicateRate(("a", "b"), 0.25), NullRate("a", 0.4)])
    assert metrics(report) == [(True, 0.25), (False, 0.5)]


def test_freshness(frame):
    df = frame("at timestamp", [("2026-03-08 10:00:00",), ("2026-03-08 09:00:00",), (None,)])
    checks = [Freshness("at", 30), Freshness("at", 4)]
    report = run_suite(df, "t", checks, as_of="2026-03-08 10:05:30")
    assert metrics(report) == [(True, 5.5), (False, 5.5)]
    assert not run_suite(df, "t", [Freshness("at", 5)]).passed


def test_foreign_key_counts_rows(frame):
    parent = frame("customer_id bigint", [(1,), (2,), (2,)])
    key = ForeignKey("customer_id", parent, "customer_id")
    good = frame("customer_id bigint", [(1,), (2,), (None,)])
    orphans = frame("customer_id bigint", [(1,), (3,), (3,), (None,)])
    assert metrics(run_suite(good, "child", [key])) == [(True, 0)]
    assert metrics(run_suite(orphans, "child", [key])) == [(False, 2)]
    assert metrics(run_suite(good.limit(0), "child", [key])) == [(True, 0)]


def test_open_ranges_and_allowed_values(frame):
    log = frame(COLUMNS, [(80, "pier", -3.5), (81, "quay", 18.0), (82, None, None), (None, "pier", 40.0)])
    checks = [
        ValueRange("reading", min_value=81),
        ValueRange("celsius", max_value=17.5),
        ValueRange("celsius", -3.5, 40.0),
        AllowedValues("station", ("pier", "mole")),
    ]
    assert metrics(run_suite(log, "log", checks)) == [(False, 1), (False, 2), (True, 0), (False, 1)]


def test_suite_is_one_scan_and_keeps_order(spark, bad, tmp_path):
    path = str(tmp_path / "log")
    bad.write.parquet(path)
    log = spark.read.parquet(path)
    assert plan_of(check_suite(log, "log", CHECKS)).count("FileScan") == 1
    known = spark.range(70, 80).withColumnRenamed("id", "number")
    mixed = [ForeignKey("reading", known, "number"), *reversed(CHECKS)]
    names = [r.check_name.removeprefix("check_") for r in run_suite(log, "log", mixed).results]
    assert names == ["referential_integrity", "value_range", "duplicate_rate", "null_rate", "row_count"]


def test_fused_equals_single_checks(bad):
    fused = run_suite(bad, "bad", CHECKS).results
    assert fused == tuple(run_suite(bad, "bad", [check]).results[0] for check in CHECKS)


def test_dictionary_suites(bad, clean):
    """Each kind of check by its dictionary equals the check built in code."""
    by_name = {
        "row_count": ({"min_row_count": 5}, RowCount(5)),
        "null_rate": ({"column_name": "station", "max_null_rate": 0.49}, NullRate("station", 0.49)),
        "duplicate_rate": ({"key_columns": ["reading"], "max_duplicate_rate": 0.5}, DuplicateRate(("reading",), 0.5)),
        "value_range": ({"column_name": "celsius", "max_value": 50.6}, ValueRange("celsius", max_value=50.6)),
        "freshness": ({"timestamp_column": "seen", "max_age_minutes": 3}, Freshness("seen", 3)),
    }
    for kind, (options, check) in by_name.items():
        assert check_from_config({"check_type": kind, **options}) == check
    key = {"child_key_column": "reading", "parent_key_column": "reading", "parent_dataframe": clean}
    suite = [{"check_type": kind, **options} for kind, (options, _) in by_name.items() if kind != "freshness"]
    report = run_suite(bad, "bad", [*suite, {"check_type": "referential_integrity", **key}])
    assert metrics(report) == [(False, 4), (False, 0.5), (True, 0.5), (False, 1), (False, 4)]
    with pytest.raises(ValueError, match="unknown check type 'sparkle'"):
        run_suite(bad, "bad", [{"check_type": "sparkle"}])
    with pytest.raises(ValueError, match="at least one check"):
        check_suite(bad, "bad", [])


def test_one_alert_per_failed_check(bad, clean):
    suite = [ValueRange("celsius", -41, 51), NullRate("station", 0.2), DuplicateRate(("reading",), 0.1)]
    alerts = alert_rows(check_suite(bad, "stations", suite))
    rows = alerts.collect()
    assert {(r.alert_type, r.severity, r.table_name) for r in rows} == {
        ("check_null_rate", "HIGH", "stations"),
        ("check_duplicate_rate", "HIGH", "stations"),
    }
    assert [json.loads(r.alert_payload)["metric_value"] for r in rows] == [0.5, 0.5]
    assert alerts.schema.names == ALERT_SCHEMA.names
    assert alert_rows(check_suite(clean, "stations", suite)).isEmpty()
    assert run_suite(alerts, "alerts", ALERTS_SUITE).passed


def test_failure_alert(spark):
    row = failure_alert(spark, "orders_pipeline", "it broke", payload={"a": 1}).first()
    assert (row.severity, row.table_name, row.pipeline_name) == ("CRITICAL", None, "orders_pipeline")
    assert json.loads(row.alert_payload) == {"a": 1} and row.event_timestamp is not None
    with pytest.raises(ValueError, match="unknown severity"):
        failure_alert(spark, "orders_pipeline", "it broke", severity="AWFUL")


def test_gates_and_constraints_name_real_columns(frame):
    sales = frame(
        "order_date string, country string, total_revenue double",
        [("2026-03-08", "PK", 1.0), ("2026-03-08", None, 2.0)],
    )
    assert metrics(run_suite(sales, "sales", DAILY_SALES_SUITE)) == [
        (True, 2),
        (False, 0.5),
        (True, 0),
        (True, 0),
    ]
    assert len(PRODUCT_FUNNEL_SUITE) == 5
    keys = frame("customer_id bigint", [(1,)])
    assert set(constraint_suites(keys, keys, keys)) == {"customers", "products", "orders", "order_items"}


def test_all_foreign_keys_of_a_child_in_one_pass(spark, frame, tmp_path):
    path = str(tmp_path / "lines")
    frame("line bigint, ship int, port string", [(1, 4, "oslo"), (2, 5, "rome"), (3, None, "oslo"), (4, 9, None), (5, 9, "kiel")]).write.parquet(path)
    lines = spark.read.parquet(path)
    ships, ports = frame("id bigint", [(4,), (5,), (5,)]), frame("name string", [("oslo",), ("kiel",)])
    keys = [ForeignKey("ship", ships, "id"), ForeignKey("port", ports, "name"), ForeignKey("line", ships, "id")]
    results = check_suite(lines, "lines", keys)
    assert plan_of(results).count("FileScan") == 1
    report = run_suite(lines, "lines", [keys[0], RowCount(5), *keys[1:]])
    assert metrics(report) == [(False, 2), (True, 5), (False, 1), (False, 3)]
    assert metrics(run_suite(lines.limit(0), "lines", keys)) == [(True, 0)] * 3


def test_constraints_count_every_row_of_products(spark, tmp_path):
    """One of 128 products comes twice: a rate of 0.0078125, halfway between six digits."""
    con = duckdb.connect()
    rows = {
        "region": "SELECT 0::INTEGER AS r_regionkey, 'ASIA' AS r_name",
        "nation": "SELECT 0::INTEGER AS n_nationkey, 'INDIA' AS n_name, 0::INTEGER AS n_regionkey",
        "customer": "SELECT k::BIGINT AS c_custkey, concat('Customer#', k) AS c_name, 0::INTEGER AS c_nationkey,"
        " 1.0::DOUBLE AS c_acctbal, 'X' AS c_mktsegment FROM range(5) t(k)",
        "part": "SELECT (k % 127)::BIGINT AS p_partkey, 'ring' AS p_name, 'B' AS p_brand, 'LARGE' AS p_type,"
        " 1::INTEGER AS p_size, 9.5::DOUBLE AS p_retailprice FROM range(128) t(k)",
        "orders": "SELECT k::BIGINT AS o_orderkey, (k % 6)::BIGINT AS o_custkey, 'O' AS o_orderstatus,"
        " 10.0::DOUBLE AS o_totalprice, TIMESTAMP '1998-01-01' AS o_orderdate, '5-LOW' AS o_orderpriority"
        " FROM range(12) t(k)",
        "lineitem": "SELECT k::BIGINT AS l_orderkey, k::BIGINT AS l_partkey, 0::BIGINT AS l_suppkey,"
        " 1::INTEGER AS l_linenumber, 2.0::DOUBLE AS l_quantity, 5.0::DOUBLE AS l_extendedprice,"
        " 0.0::DOUBLE AS l_discount, 0.0::DOUBLE AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,"
        " TIMESTAMP '1998-01-02' AS l_shipdate FROM range(14) t(k)",
    }
    for name, select in rows.items():
        con.execute(f"CREATE TABLE {name} AS {select}")
        con.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    found = all_queries()["dq_constraints"](spark, str(tmp_path))
    assert differences(found, con, all_sql()["dq_constraints"]) == []
    told = {r.message for r in found.filter("table_name = 'products' AND check_name = 'check_duplicate_rate'").collect()}
    assert "duplicate rate on product_id is 0.007812, at most 0.000000 allowed" in told
