"""Running checks together, and the gate behind them."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.quality.checks import ROWS, Check, ForeignKey, check_from_config, orphan_counts


class QualityError(RuntimeError):
    """A suite did not pass."""


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    passed: bool
    metric_value: float | str
    threshold_value: float
    message: str
    table_name: str


@dataclass(frozen=True)
class QualityReport:
    table_name: str
    results: tuple[CheckResult, ...]

    @property
    def total_checks(self) -> int:
        return len(self.results)

    @property
    def passed_checks(self) -> int:
        return sum(r.passed for r in self.results)

    @property
    def failed_checks(self) -> int:
        return self.total_checks - self.passed_checks

    @property
    def passed(self) -> bool:
        return self.failed_checks == 0

    def summary(self) -> dict[str, Any]:
        return {
            "table_name": self.table_name,
            "passed": self.passed,
            "total_checks": self.total_checks,
            "passed_checks": self.passed_checks,
            "failed_checks": self.failed_checks,
            "results": [asdict(r) for r in self.results],
        }

    def raise_if_failed(self) -> QualityReport:
        if not self.passed:
            failed = "; ".join(r.message for r in self.results if not r.passed)
            raise QualityError(f"{self.table_name}: {failed}")
        return self


def _moment(as_of: datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def check_suite(
    df: DataFrame,
    table: str,
    checks: Sequence[Check | Mapping[str, Any]],
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """One row per check. Lazy.

    All measures of the table come from a single aggregate; the foreign keys, which
    meet other tables, are one more (see `orphan_counts`). ``as_of`` stands in for the
    clock in freshness checks.
    """
    if not checks:
        raise ValueError("a suite needs at least one check")
    checks = [c if isinstance(c, Check) else check_from_config(c) for c in checks]
    now = _moment(as_of)
    measures: dict[str, Column] = {ROWS: F.count(F.lit(1))}
    verdicts: list[Column] = []
    parts: list[DataFrame] = []
    foreign: list[tuple[int, ForeignKey]] = []
    for number, check in enumerate(checks, start=1):
        if isinstance(check, ForeignKey):
            foreign.append((number, check))
            continue
        wanted = {f"m{number}_{name}": m for name, m in check.measures(now).items()}
        measures.update(wanted)
        measured = {name.split("_", 1)[1]: F.col(name) for name in wanted}
        verdict = check.judge(table, {ROWS: F.col(ROWS), **measured})
        verdicts.append(verdict.as_struct(number, check.check_name, table))
    if verdicts:
        fused = df.agg(*[measure.alias(name) for name, measure in measures.items()])
        parts.append(fused.select(F.inline(F.array(*verdicts))))
    if foreign:
        found = [
            check.judge(table, {"orphans": F.col(f"orphans_{k}")}).as_struct(number, check.check_name, table)
            for k, (number, check) in enumerate(foreign)
        ]
        orphans = orphan_counts(df, [check for _, check in foreign])
        parts.append(orphans.select(F.inline(F.array(*found))))
    return functools.reduce(DataFrame.unionByName, parts)


def report_of(table: str, rows: Sequence[Row]) -> QualityReport:
    """Report from the collected rows of a `check_suite`."""
    return QualityReport(
        table,
        tuple(
            CheckResult(
                check_name=row.check_name,
                passed=row.passed,
                metric_value=row.metric_note or row.metric_value,
                threshold_value=row.threshold_value,
                message=row.message,
                table_name=row.table_name,
            )
            for row in sorted(rows, key=lambda r: r.check_no)
        ),
    )


def run_suite(
    df: DataFrame,
    table: str,
    checks: Sequence[Check | Mapping[str, Any]],
    as_of: datetime | str | Column | None = None,
) -> QualityReport:
    """Run a suite; as many rows as there are checks reach the driver."""
    return report_of(table, check_suite(df, table, checks, as_of).collect())
