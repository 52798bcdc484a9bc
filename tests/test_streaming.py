import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalogue
from tidemark.plans.silver import to_silver_events
from tidemark.sources import parse_events, read_events, read_table
from tidemark.sources import testdata as td
from tidemark.sources.events import KAFKA_OPTIONS, MESSAGE_SCHEMA
from tidemark.spec import BRONZE_EVENT_SCHEMA
from tidemark.streaming import (
    KeyedLanding,
    dedup_stream,
    ingest_available,
    read_silver_events,
    refresh_landed,
    stream_silver_events,
    timely_stream,
    write_stream,
)
from tidemark.streaming.ingest import BOUNDED, drain, land, landed_slices

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """Messages in five files, by time of arrival."""
    path = str(tmp_path_factory.mktemp("topic") / "messages")
    messages = td.messages(td.table(spark, SF, "events"))
    messages.repartitionByRange(5, "timestamp").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def parsed(spark, topic):
    return parse_events(spark.read.parquet(topic)).drop("bronze_ingested_at")


def stream(spark, topic):
    options = {"path": topic, "maxFilesPerTrigger": "1"}
    return parse_events(read_events(spark, "parquet", options, MESSAGE_SCHEMA))


def rows(df):
    return sorted(map(str, df.collect()))


def test_payloads_are_opened_and_broken_ones_kept(frame):
    raw = frame(
        "key string, value string, timestamp timestamp",
        [
            ("k", '{"event_id": "1", "event_timestamp": "2026-03-08T12:00:00+05:00"}', "2026-03-08"),
            ("k", '{"event_id": "2", "event_timestamp": "later"}', "2026-03-08"),
            (None, "not json", "2026-03-08"),
        ],
    )
    got = {r.event_id: r for r in parse_events(raw).collect()}
    assert set(got) == {"1", "2", None}
    assert str(got["1"].event_timestamp) == "2026-03-08 07:00:00"
    assert got["1"].partition_date == "2026-03-08"
    assert got["2"].event_timestamp is None and got["2"].partition_date is None
    assert parse_events(raw).schema.names == BRONZE_EVENT_SCHEMA.names


def test_topic_defaults():
    assert KAFKA_OPTIONS == {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def test_bounded_ingest_counts_all_batches_and_resumes(spark, topic, parsed, tmp_path):
    path, offsets = str(tmp_path / "bronze"), str(tmp_path / "offsets")
    first = ingest_available(stream(spark, topic), path, offsets)
    assert (first["rows_ingested"], first["status"]) == (parsed.count(), "ingested")
    again = ingest_available(stream(spark, topic), path, offsets)
    assert (again["rows_ingested"], again["status"]) == (0, "no_new_data")
    landed = read_table(spark, path, BRONZE_EVENT_SCHEMA).select(parsed.columns)
    assert rows(landed) == rows(parsed)


def test_continuous_ingest_goes_on_from_the_same_offsets(spark, topic, parsed, tmp_path):
    path, offsets = str(tmp_path / "bronze"), str(tmp_path / "offsets")
    query = write_stream(stream(spark, topic), path, offsets, {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert ingest_available(stream(spark, topic), path, offsets)["rows_ingested"] == 0
    assert read_table(spark, path, BRONZE_EVENT_SCHEMA).count() == parsed.count()


def test_stream_dedup(spark, topic, parsed, tmp_path):
    path = str(tmp_path / "deduped")
    # The delay covers the days between a file and the events of an earlier one.
    deduped = dedup_stream(stream(spark, topic), delay="40 days")
    ingest_available(deduped, path, str(tmp_path / "offsets"))
    out = read_table(spark, path, BRONZE_EVENT_SCHEMA)
    assert out.count() == out.select("event_id").distinct().count()
    assert rows(out.select("event_id")) == rows(parsed.select("event_id").distinct())


def test_stateless_silver_on_a_stream_equals_batch(spark, topic, parsed, tmp_path):
    path = str(tmp_path / "timely")
    ingest_available(timely_stream(stream(spark, topic)), path, str(tmp_path / "offsets"))
    batch = timely_stream(parsed.withColumn("bronze_ingested_at", F.current_timestamp()))
    columns = [c for c in batch.columns if c != "bronze_ingested_at"]
    out = spark.read.schema(batch.schema).parquet(path)
    assert rows(out.select(columns)) == rows(batch.select(columns))


def test_silver_slices_follow_the_stream(spark, topic, parsed, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    # Two files a batch: slices are refreshed more than once.
    options = {"path": topic, "maxFilesPerTrigger": "2"}
    events = parse_events(read_events(spark, "parquet", options, MESSAGE_SCHEMA))
    query = stream_silver_events(events, bronze, silver, str(tmp_path / "offsets"), BOUNDED)
    assert drain(query)["status"] == "ingested"
    assert refresh_landed(spark, bronze, silver) and refresh_landed(spark, bronze, silver) == []
    taken_in = F.col("ingestion_timestamp")
    expected = to_silver_events(parsed.withColumn("bronze_ingested_at", taken_in))
    found = read_silver_events(spark, silver)
    columns = [c for c in expected.columns if c != "bronze_ingested_at"]
    assert rows(found.select(columns)) == rows(expected.select(columns))


def test_streams_and_batches_land_in_one_table(spark, topic, parsed, tmp_path):
    path, offsets = str(tmp_path / "bronze"), str(tmp_path / "offsets")
    ingest_available(stream(spark, topic), path, offsets)
    more = parse_events(spark.read.parquet(topic)).withColumn("event_id", F.concat(F.lit("x"), "event_id"))
    for _ in range(2):
        land(more, path, "again")
    landed = read_table(spark, path, BRONZE_EVENT_SCHEMA)
    assert landed.count() == 2 * parsed.count()
    assert {r.batch for r in landed_slices(spark, path).collect()} > {"again"}


def test_a_batch_run_again_replaces_itself(spark, topic, parsed, tmp_path):
    """Offsets are lost after landing: the feed takes everything in again under the same names."""
    path, offsets = str(tmp_path / "bronze"), str(tmp_path / "offsets")
    ingest_available(stream(spark, topic), path, offsets)
    (tmp_path / "offsets").rename(tmp_path / "lost")
    assert ingest_available(stream(spark, topic), path, offsets)["rows_ingested"] == parsed.count()
    assert read_table(spark, path, BRONZE_EVENT_SCHEMA).count() == parsed.count()


def test_a_folder_of_a_streaming_sink_is_refused(spark, parsed, tmp_path):
    path = tmp_path / "bronze"
    (path / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="streaming sink's log"):
        land(parsed, str(path), "b1")


def test_landing_leaves_days_alone_until_the_refresh(spark, topic, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    query = stream_silver_events(
        stream(spark, topic), bronze, silver, str(tmp_path / "offsets"), BOUNDED, refresh_every=100
    )
    drain(query)
    assert read_silver_events(spark, silver).count() == 0
    days = refresh_landed(spark, bronze, silver)
    assert days == sorted(r.slice for r in landed_slices(spark, bronze).select("slice").distinct().collect())


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Messages in six files whose rows are in no order."""
    path = str(tmp_path_factory.mktemp("shuffled") / "topic")
    messages = td.messages(td.table(spark, SF, "events"))
    messages.repartition(6, F.hash("key", F.lit(3)) if "key" in messages.columns else F.rand(3)).write.parquet(path)
    return path


def test_keyed_landing_loses_nothing_and_keeps_no_copy(spark, shuffled, parsed, tmp_path):
    landing = KeyedLanding(*(str(tmp_path / n) for n in ("kept", "late", "index")))
    options = {"path": shuffled, "maxFilesPerTrigger": "1"}
    events = parse_events(read_events(spark, "parquet", options, MESSAGE_SCHEMA))
    assert drain(landing.start(events, str(tmp_path / "offsets"), BOUNDED))["rows_ingested"] == parsed.count()
    kept, late = (read_table(spark, p, BRONZE_EVENT_SCHEMA) for p in (landing.path, landing.late_path))
    both = kept.unionByName(late)
    assert rows(both.select("event_id")) == rows(parsed.select("event_id").distinct())
    counts = landing.counts(spark)
    assert counts["rows"] == parsed.count() and counts["late"] == late.count() > 0 and counts["kept"] == kept.count()
    assert counts["copies"] == parsed.count() - both.count()
    # A batch that is run again replaces itself, and copies of it in other batches stay out.
    again = parse_events(spark.read.parquet(shuffled)).limit(0).unionByName(both.drop("bronze_ingested_at"), allowMissingColumns=True)
    landing.take(again.withColumn("bronze_ingested_at", F.current_timestamp()).select(kept.columns), "other", 0)
    landing.take(again.withColumn("bronze_ingested_at", F.current_timestamp()).select(kept.columns), "other", 0)
    after = [read_table(spark, p, BRONZE_EVENT_SCHEMA).count() for p in (landing.path, landing.late_path)]
    assert sum(after) == both.count()


def test_a_topic_has_as_many_files_as_its_size_asks_for(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 10:00:00' AS ts", "id % 90 AS user_id", "'view' AS event_type",
        "1.0D AS value", "'{\"k\": 7}' AS props",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    stored = catalogue.folder_bytes(spark, str(tmp_path / "events.parquet"))
    monkeypatch.setattr(catalogue, "TOPIC_FILE_BYTES", stored // 11)
    sizes = []
    messages = catalogue._message_files(spark, str(tmp_path)).select(F.input_file_name().alias("file"))
    stream = messages.writeStream.foreachBatch(
        lambda batch, number: sizes.append((batch.distinct().count(), batch.count()))
    )
    stream.option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 5 and {files for files, _ in sizes} == {3}
    assert sum(n for _, n in sizes) == 4000 + len(range(0, 4000, 33))
