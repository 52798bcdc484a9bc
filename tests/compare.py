"""Run catalogue queries next to their SQL: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).where(frame.notna(), None).itertuples(index=False)
    return sorted(tuple(str(v) for v in row) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What sets a Spark result apart from a DuckDB one; empty when they agree."""
    expected = con.execute(sql).df()
    actual = df.toPandas()
    if sorted(actual.columns) != sorted(expected.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"]
    if len(actual) != len(expected):
        return [f"rows {len(actual)} != {len(expected)}"]
    kinds = [
        f"{c}: {actual[c].dtype} != {expected[c].dtype}"
        for c in actual.columns
        if actual[c].dtype.kind != expected[c].dtype.kind and len(actual)
        and not {actual[c].dtype.kind, expected[c].dtype.kind} <= {"O", "T"}
    ]
    wrong = [(a, b) for a, b in zip(_sorted(actual), _sorted(expected)) if a != b]
    return kinds + [f"{len(wrong)} rows differ, first {a} != {b}" for a, b in wrong[:1]]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            found = differences(df, con, oracle_sql()[name])
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.2f}s", *found)


if __name__ == "__main__":
    main()
