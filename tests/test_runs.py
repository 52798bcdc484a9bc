"""Runs that break off after any stage, and what a later run makes of it."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalogue, gold, jobs
from tidemark.plans.ledger import Ledger
from tidemark.sinks import CommitConflict, CurrentTable, SumTable, publish_slices, publish_table, read_published
from tidemark.sinks import manifest as mf
from tidemark.sources import read_slices, read_table
from tidemark.spec import CUSTOMERS, ORDERS, schema_of

ORDER_COLUMNS = (
    "order_id bigint, order_external_id string, customer_id bigint, order_status string,"
    " order_timestamp timestamp, total_amount double, currency_code string,"
    " created_at timestamp, updated_at timestamp"
)
CUSTOMER_COLUMNS = (
    "customer_id bigint, customer_external_id string, first_name string, last_name string, email string,"
    " country_code string, city string, created_at timestamp, updated_at timestamp"
)


def order(i, day, amount, updated, customer=5):
    at = f"2021-06-{day:02} 12:00:00"
    return (i, f"o{i}", customer, "new", at, amount, "eur", at, f"2021-06-{updated:02} 13:00:00")


FIRST = [order(1, 1, 10.0, 1), order(2, 1, 3.0, 1, 6), order(3, 2, 7.0, 2)]
THEN = [order(1, 1, 99.0, 3), order(4, 1, 5.0, 3, 7), order(3, 3, 7.0, 3), order(5, 3, None, 3, 6)]
CUSTOMERS_FEED = [(c, f"c{c}", "a", "b", "a@b", land, "x", "2021-06-01", "2021-06-01 01:00:00") for c, land in ((5, "de"), (6, "fr"), (7, "de"))]


class Crash(RuntimeError):
    pass


def crash_after(stage):
    def hook(name):
        if name == stage:
            raise Crash(name)

    return hook


STAGES = ["ingest", "silver-customers", "current-customers", "silver-orders", "current-orders", "order_days", "daily_sales", "customer_segments"]


def feeds(frame, orders):
    return {"customers": frame(CUSTOMER_COLUMNS, CUSTOMERS_FEED), "orders": frame(ORDER_COLUMNS, orders)}


def sales(spark, lake):
    rows = read_table(spark, lake.gold("gold_daily_sales")).collect()
    return sorted((str(r.order_date), r.country, r.total_revenue and float(r.total_revenue), r.order_count, r.unique_customers) for r in rows)


EXPECTED = [
    ("2021-06-01", "DE", 104.0, 2, 2),
    ("2021-06-01", "FR", 3.0, 1, 1),
    ("2021-06-03", "DE", 7.0, 1, 1),
    ("2021-06-03", "FR", None, 1, 1),
]


def check_tables(spark, lake):
    assert sales(spark, lake) == EXPECTED
    ledger = Ledger(spark, lake.ledger)
    assert not any(ledger.due(s).slices for s in os.listdir(lake.ledger))
    orders, snapshot = jobs.read_current(spark, lake, ORDERS), "2021-06-30"
    jobs.build_customer_segments(spark, lake, snapshot)
    told = read_table(spark, lake.gold("gold_customer_segments")).filter(f"snapshot_date = '{snapshot}'")
    expected = gold.rfm_base(orders, snapshot)
    assert sorted(map(str, told.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("stage", ["silver-orders", "order_days"])
def test_a_run_that_breaks_off_is_made_up_for(spark, frame, tmp_path, stage):
    """Both runs break off once after the stage; each is repeated for a day nothing happened on."""
    lake = jobs.Lake(str(tmp_path))
    for known, day in ((FIRST, "2021-06-02"), ([*FIRST, *THEN], "2021-06-03")):
        with pytest.raises(Crash):
            jobs.run_orders(spark, lake, feeds(frame, known), day, gate=False, after=crash_after(stage))
        jobs.run_orders(spark, lake, feeds(frame, known), "2021-06-20", gate=False)
    check_tables(spark, lake)


def test_a_run_that_breaks_off_again_and_again(spark, frame, tmp_path):
    """Every attempt breaks off one stage later than the one before, each for another day."""
    lake = jobs.Lake(str(tmp_path))
    jobs.run_orders(spark, lake, feeds(frame, FIRST), "2021-06-02", gate=False)
    for k, stage in enumerate(STAGES):
        with pytest.raises(Crash):
            jobs.run_orders(spark, lake, feeds(frame, [*FIRST, *THEN]), f"2021-06-{10 + k}", gate=False, after=crash_after(stage))
    jobs.run_orders(spark, lake, feeds(frame, [*FIRST, *THEN]), "2021-06-20", gate=False)
    check_tables(spark, lake)


@pytest.mark.parametrize("broken", ["publish_slices", "advance_current", "advance_order_days", "build_daily_sales"])
def test_a_stage_that_fails_inside_is_made_up_for(spark, frame, tmp_path, monkeypatch, broken):
    lake = jobs.Lake(str(tmp_path))
    jobs.run_orders(spark, lake, feeds(frame, FIRST), "2021-06-02", gate=False)

    def fails(*args, **kwargs):
        raise Crash(broken)

    with monkeypatch.context() as patch, pytest.raises(Crash):
        patch.setattr(jobs, broken, fails)
        jobs.run_orders(spark, lake, feeds(frame, [*FIRST, *THEN]), "2021-06-03", gate=False)
    jobs.run_orders(spark, lake, feeds(frame, [*FIRST, *THEN]), "2021-06-20", gate=False)
    assert sales(spark, lake) == EXPECTED


def test_a_commit_of_order_days_counts_once(spark, frame, tmp_path, monkeypatch):
    """Broken off between the commit and what follows it."""
    lake = jobs.Lake(str(tmp_path))
    with monkeypatch.context() as patch, pytest.raises(Crash):
        patch.setattr(CurrentTable, "forget", lambda self, upto: (_ for _ in ()).throw(Crash()))
        jobs.run_orders(spark, lake, feeds(frame, FIRST), "2021-06-02", gate=False)
    jobs.run_orders(spark, lake, feeds(frame, FIRST), "2021-06-20", gate=False)
    assert [r[2] for r in sales(spark, lake)] == [10.0, 3.0, 7.0]


# --- published tables ----------------------------------------------------------------

SLICED = schema_of("id bigint, day string")


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_reader_sees_old_or_new(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    old = frame("id bigint, day string", [(1, "a"), (2, "b"), (3, "c")])
    assert publish_slices(old, path, "day", ["a", "b", "c"]) == 3
    before = read_table(spark, path, SLICED)
    part = read_slices(spark, path, SLICED, ["b", "nowhere"], "day")
    new = frame("id bigint, day string", [(4, "a"), (5, "a")])
    assert publish_slices(new, path, "day", ["a", "b"]) == 2
    assert content(before) == [(1, "a"), (2, "b"), (3, "c")] and content(part) == [(2, "b")]
    assert content(read_table(spark, path, SLICED)) == [(3, "c"), (4, "a"), (5, "a")]
    # What the first commit wrote for a and b goes with the next commit.
    publish_slices(new, path, "day", ["a"])
    assert sorted(os.listdir(f"{path}/_data/v=1")) in (["_SUCCESS", "day=c"], ["._SUCCESS.crc", "_SUCCESS", "day=c"])


def test_a_failed_publish_changes_nothing(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_slices(frame("id bigint, day string", [(1, "a")]), path, "day", ["a"])
    for stray in ("c", None):
        with pytest.raises(Exception, match="not among the slices"):
            publish_slices(frame("id bigint, day string", [(2, "a"), (3, stray)]), path, "day", ["a"])
    with monkeypatch.context() as patch, pytest.raises(Crash):
        patch.setattr(mf, "write_file", lambda *a: (_ for _ in ()).throw(Crash()))
        publish_slices(frame("id bigint, day string", [(4, "a")]), path, "day", ["a"])
    assert content(read_table(spark, path)) == [(1, "a")]
    assert publish_slices(frame("id bigint, day string", []), path, "day", ["a"]) == 0
    assert content(read_table(spark, path)) == [] and read_table(spark, path).columns == ["id", "day"]


def test_whole_tables_and_two_writers(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("id bigint, day string", [(1, "a"), (2, "b")])
    assert publish_table(df, path, "day") == 2
    assert publish_table(read_published(spark, path).filter("id = 2"), path, "day") == 1
    assert content(read_published(spark, path)) == [(2, "b")]
    assert publish_table(df, str(tmp_path / "plain")) == 2 and content(read_table(spark, str(tmp_path / "plain"))) == content(df)
    now = mf.manifest_of(spark, path)
    mf.commit(spark, path, now, now.entries)
    with pytest.raises(CommitConflict):
        mf.commit(spark, path, now, now.entries)


# --- tables of runs ------------------------------------------------------------------


def bytes_below(path):
    return sum(os.path.getsize(os.path.join(r, f)) for r, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def rows(spark, ids, updated, amount):
    audit = "'s' AS source_table, timestamp'2021-01-01' AS ingested_at, '2021-01-01' AS partition_date"
    return ids.selectExpr(
        "id AS order_id", "concat('o', id) AS order_external_id", "id % 997 AS customer_id", "'new' AS order_status",
        "timestamp_seconds(1600000000 + id * 61) AS order_timestamp", f"CAST({amount} AS decimal(14,2)) AS total_amount",
        "'EUR' AS currency_code", "timestamp'2021-01-01' AS created_at", f"timestamp'{updated}' AS updated_at", *audit.split(", "),
    )


def test_writes_follow_the_changes_not_the_table(spark, tmp_path):
    table = CurrentTable.of(spark, str(tmp_path / "t"), ORDERS)
    assert table.apply(rows(spark, spark.range(200_000), "2021-01-01", "id % 50"))
    size = bytes_below(tmp_path)
    changed = spark.range(200_000).filter("pmod(xxhash64(id), 200) = 7")
    n = changed.count()
    assert 800 < n < 1200
    assert table.apply(rows(spark, changed, "2021-02-01", "1000"))
    grown = bytes_below(tmp_path) - size
    assert grown < 10 * size * n / 200_000
    now = table.read()
    assert now.count() == 200_000 and now.filter("total_amount = 1000").count() == n
    log = table.log(1).groupBy("sign").agg(F.count("*").alias("n"), F.sum("total_amount").alias("s")).collect()
    told = {r.sign: (r.n, float(r.s)) for r in log}
    assert told[1] == (n, 1000.0 * n) and told[-1][0] == n
    # The same again, and older versions, change nothing.
    version = table.version
    assert not table.apply(rows(spark, changed, "2021-02-01", "1000"))
    assert not table.apply(rows(spark, changed, "2020-02-01", "3"))
    assert table.version == version


def test_many_commits_are_merged_by_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mf, "FAN", 3)
    table = CurrentTable.of(spark, str(tmp_path / "t"), ORDERS)
    table.apply(rows(spark, spark.range(1000), "2021-01-01", "1"))
    expected = dict.fromkeys(range(1000), 1.0)
    for k in range(1, 12):
        changed = spark.range(k * 7, k * 7 + 20)
        table.apply(rows(spark, changed, f"2021-02-{k:02}", str(100 + k)))
        expected |= dict.fromkeys(range(k * 7, k * 7 + 20), 100.0 + k)
    runs = mf.manifest_of(spark, table.path).entries["runs"]
    assert len(runs) < 7 and runs[0]["rows"] >= 1000 and max(r["level"] for r in runs[1:]) >= 1
    assert {r.order_id: float(r.total_amount) for r in table.read().collect()} == expected
    assert table.log(0).filter("sign = 1").count() == 1000 + 11 * 20
    table.forget(table.version)
    assert table.log(0).isEmpty() and table.read().count() == 1000


def test_sums_take_back_what_they_added(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(mf, "FAN", 2)
    schema = schema_of("k string, n bigint, m bigint")
    table = SumTable(spark, str(tmp_path / "t"), ("k",), schema, ("n", "m"))
    steps = [[("a", 5, 1), ("b", 2, 1), (None, 1, 1)], [("a", -2, 0)], [("b", -2, -1)], [("c", 9, 1)], [("a", 1, 1), (None, -1, -1)]]
    for k, step in enumerate(steps, start=1):
        table.add(frame("k string, n bigint, m bigint", step), k)
    assert content(table.read()) == [("a", 4, 2), ("c", 9, 1)] and table.position == 5


def test_customers_without_changes_are_not_rewritten(spark, tmp_path):
    table = CurrentTable.of(spark, str(tmp_path / "t"), CUSTOMERS)
    assert table.read().isEmpty() and not table.apply(spark.createDataFrame([], CUSTOMERS.schema))
    assert table.version == 0 and table.log().isEmpty()


def test_a_table_that_nothing_follows_keeps_no_log(spark, tmp_path):
    tables = [CurrentTable.of(spark, str(tmp_path / name), ORDERS, followed=name == "f") for name in "fu"]
    for table in tables:
        assert not table.apply(rows(spark, spark.range(0), "2021-01-01", "1"))
        assert table.apply(rows(spark, spark.range(50), "2021-01-01", "1"))
        assert table.apply(rows(spark, spark.range(40, 60), "2021-02-01", "2"))
        assert not table.apply(rows(spark, spark.range(40, 60), "2020-02-01", "3"))
    followed, plain = tables
    assert content(plain.read()) == content(followed.read()) and plain.version == followed.version
    assert followed.log().count() == 50 + 20 + 10 and plain.log().isEmpty()
    assert not (tmp_path / "u" / "_data" / "log").exists()


def test_every_query_fills_a_lake_of_its_own(spark, tmp_path):
    filled = []
    lakes = [catalogue._lake(spark, str(tmp_path), lambda s, d, lake: filled.append(lake.root)) for _ in range(2)]
    assert [lake.root for lake in lakes] == filled and len(set(filled)) == 2
