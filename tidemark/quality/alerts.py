"""Alert rows for failed checks and failed runs."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import schema_of

# Severity domain of an alert.
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# Origin and kind written into alert rows.
QUALITY_ORIGIN = {"alert_source": "quality_runner", "pipeline_name": "data_quality"}
FAILURE_ORIGIN = {"alert_source": "airflow_pipeline", "alert_type": "pipeline_failure"}

ALERT_SCHEMA = schema_of(
    "alert_source string, alert_type string, severity string, table_name string,"
    " pipeline_name string, alert_message string, alert_payload string,"
    " event_timestamp timestamp, resolved_at timestamp, created_at timestamp,"
    " updated_at timestamp"
)


def _alerts(
    df: DataFrame, values: Mapping[str, Column], as_of: datetime | str | None
) -> DataFrame:
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    stamps = {name: now for name in ("event_timestamp", "created_at", "updated_at")}
    filled = {**stamps, "resolved_at": F.lit(None), **values}
    return df.select(*[filled[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def alert_rows(results: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One alert per failed check of a `check_suite` result."""
    return _alerts(
        results.filter(~F.col("passed")),
        {
            **{name: F.lit(value) for name, value in QUALITY_ORIGIN.items()},
            "alert_type": F.col("check_name"),
            "severity": F.lit("HIGH"),
            "table_name": F.col("table_name"),
            "alert_message": F.col("message"),
            "alert_payload": F.to_json(F.struct(*[c for c in results.columns if c != "check_no"])),
        },
        as_of,
    )


def failure_alert(
    spark: SparkSession,
    run_name: str,
    message: str,
    severity: str = "CRITICAL",
    payload: Mapping[str, Any] | None = None,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """The alert of a run that broke off, as a one-row frame."""
    if severity not in SEVERITIES:
        raise ValueError(f"unknown severity {severity!r}, expected one of {SEVERITIES}")
    return _alerts(
        spark.range(1),
        {
            **{name: F.lit(value) for name, value in FAILURE_ORIGIN.items()},
            "severity": F.lit(severity),
            "table_name": F.lit(None),
            "pipeline_name": F.lit(run_name),
            "alert_message": F.lit(message),
            "alert_payload": F.lit(json.dumps(dict(payload or {}))),
        },
        as_of,
    )
