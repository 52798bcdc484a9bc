"""Merged batch folders: readers see the same rows before, during and after."""

import os

import pytest

from tidemark.plans import jobs
from tidemark.sinks import landed as ld
from tidemark.sinks import land_batch, merge_landed, publish_table, read_landed_as_is
from tidemark.sinks import manifest as mf
from tidemark.sources import read_slices, read_table
from tidemark.spec import schema_of
from tidemark.streaming import KeyedLanding, landed_slices
from tidemark.streaming.ingest import land, landed_log

COLUMNS = "id bigint, note string, day string"
SCHEMA = schema_of(COLUMNS)
WITH_BATCH = schema_of(f"{COLUMNS}, batch string")


def rows(df):
    return sorted(map(str, df.collect()))


def fill(frame, path, batches=5, first=0):
    for b in range(first, first + batches):
        days = ["2024-01-01", "2024-01-02", None]
        land_batch(frame(COLUMNS, [(10 * b + i, f"n{b}", d) for i, d in enumerate(days)]), path, f"b-{b}", "day")


def batch_files(path):
    return [f for d, _, names in os.walk(path) if "_data" not in d and "batch=" in d for f in names if f.endswith(".parquet")]


def test_same_rows_before_during_and_after(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    fill(frame, path)
    expected, one = rows(read_table(spark, path, WITH_BATCH)), rows(read_slices(spark, path, SCHEMA, ["2024-01-02"], "day"))
    assert len(expected) == 15 and len(one) == 5
    reader = read_table(spark, path, WITH_BATCH)
    assert merge_landed(spark, path, "day", least_files=3) == {"slices": 3, "files": 15, "rows": 15}
    # Files that were replaced stay for readers that began before, and count once.
    assert rows(reader) == expected == rows(read_table(spark, path, WITH_BATCH)) and len(batch_files(path)) == 15
    assert rows(read_slices(spark, path, SCHEMA, ["2024-01-02"], "day")) == one
    assert read_slices(spark, path, SCHEMA, ["1999-01-01"], "day").isEmpty()
    fill(frame, path, 1, 5)
    more = rows(read_table(spark, path, WITH_BATCH))
    assert set(expected) < set(more) and len(more) == 18
    # Too few new files: only what went before is taken away.
    assert merge_landed(spark, path, "day", least_files=3)["slices"] == 0
    assert rows(read_table(spark, path, WITH_BATCH)) == more and len(batch_files(path)) == 3
    fill(frame, path, 3, 6)
    more = rows(read_table(spark, path, WITH_BATCH))
    assert merge_landed(spark, path, "day", ["2024-01-01", "none"], least_files=3)["slices"] == 1
    assert rows(read_table(spark, path, WITH_BATCH)) == more
    assert rows(read_landed_as_is(spark, path).select(WITH_BATCH.names)) == more


def test_a_batch_landed_again_stands_for_itself(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    fill(frame, path)
    merge_landed(spark, path, "day", least_files=3)

    def again(note):
        land_batch(frame(COLUMNS, [(10, note, "2024-01-01"), (99, note, "2024-01-01")]), path, "b-1", "day")

    def seen():
        return sorted((r.id, r.note) for r in read_slices(spark, path, SCHEMA, ["2024-01-01"], "day").collect())

    others = [(0, "n0"), (20, "n2"), (30, "n3"), (40, "n4")]
    again("x")  # its replaced files are still there to be removed
    assert seen() == sorted([*others, (10, "x"), (99, "x")])
    merge_landed(spark, path, "day", least_files=100)
    assert seen() == sorted([*others, (10, "x"), (99, "x")])
    merge_landed(spark, path, "day", least_files=1)
    assert seen() == sorted([*others, (10, "x"), (99, "x")])
    again("y")  # its replaced files are gone after this
    merge_landed(spark, path, "day", least_files=100)
    again("z")
    # Also where the folder that has the old rows would not be taken along.
    merge_landed(spark, path, "day", least_files=1, file_bytes=5000)
    merge_landed(spark, path, "day", least_files=100)
    assert seen() == sorted([*others, (10, "z"), (99, "z")])


@pytest.mark.parametrize("broken", ["commit", "remove_if_empty", "remove_file"])
def test_a_merge_that_breaks_off_changes_nothing(spark, frame, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "t")
    fill(frame, path)
    if broken != "commit":
        merge_landed(spark, path, "day", least_files=3)
        fill(frame, path, 3, 5)
    expected = rows(read_table(spark, path, WITH_BATCH))
    calls = []

    def fail(*args, **kwargs):
        calls.append(args)
        if broken == "commit" or len(calls) > 4:
            raise OSError("lost")
        return real(*args, **kwargs)

    real = getattr(ld, broken)
    with monkeypatch.context() as m:
        m.setattr(ld, broken, fail)
        with pytest.raises(OSError, match="lost"):
            merge_landed(spark, path, "day", least_files=3)
    assert rows(read_table(spark, path, WITH_BATCH)) == expected
    assert merge_landed(spark, path, "day", least_files=3)["slices"] == 3
    merge_landed(spark, path, "day", least_files=3)
    assert rows(read_table(spark, path, WITH_BATCH)) == expected and not batch_files(path)


def test_rows_are_rewritten_a_logarithmic_number_of_times(spark, frame, tmp_path):
    path, written, total = str(tmp_path / "t"), 0, 0
    for b in range(24):
        land_batch(frame(COLUMNS, [(100 * b + i, f"{b}-{i}" * 9, "2024-01-01") for i in range(50)]), path, f"b-{b}", "day")
        total += 50
        if b % 2:
            written += merge_landed(spark, path, "day", least_files=2)["rows"]
    assert read_table(spark, path, SCHEMA).count() == total and total <= written <= 6 * total


def test_columns_of_some_batches_and_types(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    land_batch(frame("id int, day string", [(1, "007")]), path, "1", "day")
    land_batch(frame("id int, extra string, day string", [(2, "e", "007")]), path, "2", "day")
    merge_landed(spark, path, "day", least_files=2)
    got = read_landed_as_is(spark, path, ["007"])
    assert sorted(tuple(r) for r in got.select("id", "extra", "day", "batch").collect()) == [(1, None, "007", "1"), (2, "e", "007", "2")]
    assert dict(got.dtypes)["id"] == "int"
    assert read_landed_as_is(spark, path, ["008"]) is None
    land_batch(frame("id string, day string", [("x", "007"), ("y", "008")]), path, "3", "day")
    land_batch(frame("id int, day string", [(5, "007"), (6, "008")]), path, "4", "day")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_landed(spark, path, "day", least_files=2)


def test_what_is_no_landed_table_is_refused(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish_table(frame(COLUMNS, [(1, "a", "2024-01-01")]), path, "day")
    with pytest.raises(ValueError, match="no landed table"):
        merge_landed(spark, path, "day")
    assert merge_landed(spark, str(tmp_path / "none"), "day") == {"slices": 0, "files": 0, "rows": 0}


def test_bronze_and_its_log(spark, frame, tmp_path):
    """Refreshes and Silver read the same from merged Bronze tables."""
    lake = jobs.Lake(str(tmp_path / "lake"))
    spec = jobs.CUSTOMERS
    for b in range(4):
        raw = frame(
            "customer_id bigint, email string, updated_at timestamp, partition_date string",
            [(b, f"E{b}@X.de ", f"2024-01-0{1 + b % 2} 10:00:00", f"2024-01-0{1 + b % 2}")],
        )
        missing = [f for f in spec.schema if f.name not in raw.columns]
        land_batch(raw.selectExpr("*", *[f"cast(null as {f.dataType.simpleString()}) {f.name}" for f in missing]), lake.bronze("customers"), f"c{b}")
        land(frame("event_id string, partition_date string", [(f"e{b}", "2024-01-01")]), lake.bronze_events, f"b-{b}")
    log = rows(landed_slices(spark, lake.bronze_events))
    bronze = [rows(jobs._bronze_slices(spark, lake.bronze("customers"), spec, ["2024-01-01", "2024-01-02"]).select(spec.schema.names))]
    assert jobs.merge_bronze(spark, lake, least_files=2) == {
        "customers": {"slices": 2, "files": 4, "rows": 4},
        "events": {"slices": 1, "files": 4, "rows": 4},
        "events_log": {"slices": 1, "files": 4, "rows": 4},
    }
    bronze.append(rows(jobs._bronze_slices(spark, lake.bronze("customers"), spec, ["2024-01-01", "2024-01-02"]).select(spec.schema.names)))
    assert len(log) == 4 and rows(landed_slices(spark, lake.bronze_events)) == log
    assert len(bronze[0]) == 4 and bronze[0] == bronze[1]
    land(frame("event_id string, partition_date string", [("e9", "2024-01-03")]), lake.bronze_events, "b-9")
    assert landed_slices(spark, lake.bronze_events).count() == 5
    assert mf.is_managed(spark, landed_log(lake.bronze_events))


def test_index_of_keys_can_be_merged(spark, frame, tmp_path):
    landing = KeyedLanding(*(str(tmp_path / n) for n in ("t", "late", "index")), keys=("event_id",))
    columns = "event_id string, event_timestamp timestamp, partition_date string"
    for b in range(3):
        landing.take(frame(columns, [(f"e{b}", "2024-01-01 10:00:00", "2024-01-01")]), "f", b)
    assert merge_landed(spark, landing.index_path, "slice", least_files=2)["rows"] == 3
    landing.take(frame(columns, [(f"e{b}", "2024-01-01 10:00:00", "2024-01-01") for b in range(5)]), "f", 3)
    assert landing.counts(spark) == {"rows": 8, "kept": 5, "late": 0, "copies": 3}
