from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import current_snapshot, keep_one_by_key, with_session_metrics
from tidemark.plans.silver import deduped_events
from tidemark.spec import EVENTS, ORDERS

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
VERSION = "order_id bigint, order_status string, updated_at timestamp, ingested_at timestamp"


def test_ties_between_versions_go_to_the_one_taken_in_last(frame):
    at = "2018-05-05 05:05:05"
    versions = [(41, f"copy {h}", at, f"2018-05-0{h} 00:00:00") for h in (6, 8, 7)]
    versions += [(42, "only", None, None), (41, "old", "2018-05-05 05:05:04", "2018-05-09 00:00:00")]
    rows = current_snapshot(frame(VERSION, versions), ORDERS).collect()
    assert sorted((r.order_id, r.order_status) for r in rows) == [(41, "copy 8"), (42, "only")]


@FEW
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40))
def test_dedup_is_key_unique_and_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    once = keep_one_by_key(df, ["k"], [F.desc("v")])
    twice = keep_one_by_key(once, ["k"], [F.desc("v")])
    expected = {k: max(v for key, v in rows if key == k) for k, _ in rows}
    assert dict(once.collect()) == dict(twice.collect()) == expected


def test_copies_are_cut_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(keep_one_by_key(df, ["k"], [F.desc("id")]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def event_rows(frame, rows):
    """(event_id, session_id, type, event time, ingestion time) on 2026-03-08."""
    filled = [
        dict.fromkeys(EVENTS.columns)
        | {
            "event_id": e,
            "session_id": s,
            "user_id": "u",
            "event_type": kind,
            "event_timestamp": f"2026-03-08 {at}",
            "ingestion_timestamp": f"2026-03-08 {got}",
            "bronze_ingested_at": f"2026-03-08 {got}",
            "partition_date": "2026-03-08",
        }
        for e, s, kind, at, got in rows
    ]
    columns = ", ".join(f"{c} string" for c in EVENTS.columns)
    return frame(columns, [tuple(r.values()) for r in filled])


def test_of_three_copies_the_earliest_arrival_is_kept(frame):
    arrivals = ["18:30:00", "18:00:00.25", "18:00:00.5"]
    df = event_rows(frame, [("q", "w", "checkout", "17:59:00", at) for at in arrivals])
    (row,) = deduped_events(df).collect()
    assert row.ingestion_timestamp.microsecond == 250_000


def windowed(df):
    w = Window.partitionBy("session_id")
    return df.select(
        "event_id",
        F.count(F.lit(1)).over(w).alias("session_event_count"),
        F.min("event_timestamp").over(w).alias("session_start_time"),
        F.max("event_timestamp").over(w).alias("session_end_time"),
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(w).alias("bought"),
    )


def skewed_events(spark, rows):
    """A third of all events belong to one session."""
    session = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("s"), (F.col("id") / 5).cast("int"))
    )
    kind = F.when(F.col("id") % 7 == 0, F.lit("purchase")).otherwise(F.lit("view"))
    return spark.range(rows).select(
        session.alias("session_id"),
        F.col("id").alias("event_id"),
        kind.alias("event_type"),
        F.timestamp_seconds(F.col("id") * 60).alias("event_timestamp"),
    )


def test_session_metrics_equal_a_window(spark):
    df = skewed_events(spark, 600)
    found = with_session_metrics(df).select(
        "event_id",
        "session_event_count",
        "session_start_time",
        "session_end_time",
        F.col("is_conversion").cast("int").alias("bought"),
    )
    assert sorted(found.collect()) == sorted(windowed(df).collect())


def test_session_length_and_conversion(frame):
    df = event_rows(
        frame,
        [
            ("a", "s1", "page_view", "10:00:00", "10:00:01"),
            ("b", "s1", "purchase", "10:01:30.9", "10:01:31"),
            ("c", "s2", "page_view", "11:00:00", "11:00:01"),
        ],
    )
    rows = with_session_metrics(deduped_events(df), ["session_id", "partition_date"]).collect()
    metrics = {
        r.event_id: (r.session_event_count, r.session_duration_seconds, r.is_conversion)
        for r in rows
    }
    assert metrics == {"a": (2, 90, True), "b": (2, 90, True), "c": (1, 0, False)}


def test_hot_session_is_spread_over_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    path = str(tmp_path / "events")
    # In files small enough that one map task holds only some rows of the hot session.
    skewed_events(spark, 60_000).repartition(16).write.parquet(path)
    settings |= {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = with_session_metrics(spark.read.parquet(path))
        hot = (F.col("session_id") == "hot").alias("hot")
        per_task = out.select(F.spark_partition_id().alias("task"), hot).groupBy("task", "hot").count().filter("hot")
        counts = [r["count"] for r in per_task.collect()]
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(counts) == 20_000 and len(counts) >= 2 and max(counts) < 15_000
