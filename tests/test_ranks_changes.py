from decimal import Decimal

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import (
    add_ntiles,
    apply_changes,
    changes_after,
    current_snapshot,
    high_watermark,
    rows_at_ranks,
)
from tidemark.spec import TableSpec

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TILES = {"up": ("v", False), "down": ("v", True), "other": ("w", False)}


def global_ntiles(df, k):
    return (
        df.withColumn("up", F.ntile(k).over(Window.orderBy("v", "id")))
        .withColumn("down", F.ntile(k).over(Window.orderBy(F.desc("v"), "id")))
        .withColumn("other", F.ntile(k).over(Window.orderBy("w", "id")))
    )


@FEW
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60),
    k=st.integers(1, 7),
)
def test_ntiles_equal_the_global_window(spark, values, k):
    rows = [(i, v, Decimal(i % 4)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, v int, w decimal(10,2)")
    assert sorted(add_ntiles(df, "id", k, TILES).collect(), key=lambda r: r.id) == sorted(
        global_ntiles(df, k).collect(), key=lambda r: r.id
    )


def test_ntiles_of_a_heavy_value_and_doubles(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"), F.rand(1).alias("w")
    )
    out = add_ntiles(df.withColumn("w", F.round("w", 2)), "id", 5, TILES)
    wrong = out.join(
        global_ntiles(df.withColumn("w", F.round("w", 2)), 5).select(
            "id", *[F.col(c).alias(f"{c}_") for c in TILES]
        ),
        "id",
    ).filter("up <> up_ OR down <> down_ OR other <> other_")
    assert wrong.count() == 0
    plan = plan_of(out)
    assert "SinglePartition" not in plan and "Exchange" not in plan


def test_ntiles_of_no_rows(spark):
    empty = spark.createDataFrame([], "id long, v int, w int")
    assert add_ntiles(empty, "id", 5, TILES).count() == 0


def test_rows_at_ranks(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), (999 - F.col("id")).alias("v"))
    found = rows_at_ranks(df, ["v"], {0: lambda n: [1, n], 1: lambda n: [n // 2, n + 1]}, "g")
    assert {rank: row.v for rank, row in found[0].items()} == {1: 1, 500: 999}
    assert {rank: row.v for rank, row in found[1].items()} == {250: 498}


# --- change feeds -------------------------------------------------------------------

FEED = "id bigint, updated_at timestamp, value string"


def feed(frame, stamps):
    return frame(FEED, [(i, f"2026-03-08 10:00:0{s}", f"v{i}") for i, s in enumerate(stamps)])


def test_changes_after_a_composite_watermark(frame):
    df = feed(frame, [0, 1, 1, 1, 2])
    at = {"updated_at": "2026-03-08 10:00:01", "id": 2}
    assert {r.id for r in changes_after(df, "updated_at", ["id"], at).collect()} == {3, 4}
    instant = {"updated_at": "2026-03-08 10:00:01"}
    assert {r.id for r in changes_after(df, "updated_at", ["id"], instant).collect()} == {4}
    assert changes_after(df, "updated_at", ["id"]).count() == 5


def test_replaying_in_batches_loses_nothing(frame):
    stamps = [1, 1, 1, 1, 0, 2, 1, 2, 2]
    df = feed(frame, stamps)
    for limit in (1, 4, len(stamps)):
        position, seen = None, []
        while True:
            batch = changes_after(df, "updated_at", ["id"], position, limit)
            ids = sorted(r.id for r in batch.collect())
            if not ids:
                break
            assert len(ids) <= limit
            seen += ids
            position = high_watermark(batch, "updated_at", ["id"]).first().asDict()
        assert sorted(seen) == list(range(len(stamps)))


def test_a_limit_takes_the_oldest_rows(spark):
    df = spark.range(3000).select(
        "id", F.timestamp_seconds((F.col("id") * 7919) % 50).alias("updated_at")
    )
    at = {"updated_at": "1970-01-01 00:00:10", "id": 77}
    after = changes_after(df, "updated_at", ["id"], at)
    found = changes_after(df, "updated_at", ["id"], at, 1234)
    assert sorted(found.collect()) == sorted(after.orderBy("updated_at", "id").limit(1234).collect())


def test_high_watermark(frame):
    df = feed(frame, [0, 2, 2, 1])
    top = high_watermark(df, "updated_at", ["id"]).first()
    assert (str(top.updated_at), top.id) == ("2026-03-08 10:00:02", 2)
    none = df.filter("id > 100")
    at = {"updated_at": "1970-01-01 00:00:00", "id": -1}
    fallback = high_watermark(none, "updated_at", ["id"], at).first()
    assert (str(fallback.updated_at), fallback.id) == ("1970-01-01 00:00:00", -1)
    assert high_watermark(none, "updated_at", ["id"]).first().id is None


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.range(10).select("id", F.timestamp_seconds("id").alias("updated_at")).write.parquet(path)
    at = {"updated_at": "1970-01-01 00:00:05", "id": 5}
    plan = plan_of(changes_after(spark.read.parquet(path), "updated_at", ["id"], at))
    assert "GreaterThanOrEqual(updated_at" in plan


def test_apply_changes(frame):
    spec = TableSpec("t", (), (), ("id",), (("updated_at", "desc"),))
    stored = frame(FEED, [(1, "2026-03-08 10:00:00", "a"), (2, "2026-03-08 12:00:00", "newer")])
    changes = frame(
        FEED,
        [
            (1, "2026-03-08 11:00:00", "b"),
            (2, "2026-03-08 11:00:00", "older"),
            (3, "2026-03-08 11:00:00", "new"),
        ],
    )
    result = {r.id: r.value for r in apply_changes(stored, changes, spec).collect()}
    assert result == {1: "b", 2: "newer", 3: "new"}
    assert current_snapshot(stored, spec).count() == 2
