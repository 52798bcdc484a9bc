from tidemark.quality.alerts import ALERT_SCHEMA, SEVERITIES, alert_rows, failure_alert
from tidemark.quality.checks import (
    AllowedValues,
    Check,
    DuplicateRate,
    ForeignKey,
    Freshness,
    NullRate,
    RowCount,
    ValueRange,
    check_from_config,
)
from tidemark.quality.suite import (
    CheckResult,
    QualityError,
    QualityReport,
    check_suite,
    report_of,
    run_suite,
)

__all__ = [
    "ALERT_SCHEMA",
    "SEVERITIES",
    "AllowedValues",
    "Check",
    "CheckResult",
    "DuplicateRate",
    "ForeignKey",
    "Freshness",
    "NullRate",
    "QualityError",
    "QualityReport",
    "RowCount",
    "ValueRange",
    "alert_rows",
    "check_from_config",
    "check_suite",
    "failure_alert",
    "report_of",
    "run_suite",
]
