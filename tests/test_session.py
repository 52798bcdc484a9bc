import pytest
from pyspark.errors import AnalysisException

from tidemark import staged, tune
from tidemark.session import free, shared_folder, staging


def test_shuffle_partitions_grow_with_the_input(spark):
    try:
        tune(spark, shuffle_bytes=10**9)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        tune(spark, shuffle_bytes=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_partitions_go_back_to_the_sessions_own(spark):
    def after(size):
        return tune(spark, shuffle_bytes=size).conf.get("spark.sql.shuffle.partitions")

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert after(10**10) == "75" and after(1) == before
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        assert after(1) == "9" and after(10**10) == "75" and after(1) == "9"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_staged_rows_can_be_freed(spark):
    import os

    df = staged(spark.range(10), "numbers")
    path = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert df.count() == 10 and os.path.exists(path)
    free(df, spark.range(3))
    assert not os.path.exists(path)


def test_staged_rows_lie_in_the_shared_folder(spark):
    df = staged(spark.range(10), "numbers")
    assert shared_folder(spark) in df.inputFiles()[0] and df.count() == 10
    with staging(spark.range(10), "numbers") as inside:
        assert inside.count() == 10
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
    # The folder goes with the block.
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
