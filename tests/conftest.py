from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark import tune  # noqa: E402
from tidemark.spec import schema_of  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> Iterator[SparkSession]:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark: SparkSession) -> Callable[[str, list[tuple]], DataFrame]:
    """Frame from rows and "name type" columns; timestamps are given as text."""

    def build(columns: str, rows: list[tuple]) -> DataFrame:
        schema = schema_of(columns)
        text = schema_of(", ".join(f"{f.name} string" for f in schema))
        cells = [tuple(None if v is None else str(v) for v in row) for row in rows]
        df = spark.createDataFrame(cells, text)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])

    return build


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
