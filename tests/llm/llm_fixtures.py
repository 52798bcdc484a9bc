"""Fixtures of these tests; in no conftest, whose name the tests above use."""

from __future__ import annotations

from collections.abc import Callable

import pytest
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import ready

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark: SparkSession) -> SparkSession:
    return ready(spark)


@pytest.fixture(scope="session")
def docs_of(llm: SparkSession) -> Callable[[list], DataFrame]:
    """Documents from (doc_id, text) pairs or (doc_id, text, lang, source)."""

    def build(rows: list) -> DataFrame:
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1]) if r[1] else None) for r in rows]
        return llm.createDataFrame(full, DOCS)

    return build
