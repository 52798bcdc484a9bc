"""Data-quality checks as aggregate expressions.

A check names what it measures (aggregates over the table) and judges the measured
values. It runs nothing itself, so a suite can compute all measures in one job.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "rows"


@dataclass(frozen=True)
class Verdict:
    """Judgement over measured columns. ``note`` says why there is no metric."""

    passed: Column
    metric: Column
    threshold: float
    message: Column
    note: Column | None = None

    def as_struct(self, number: int, check_name: str, table: str) -> Column:
        note = F.lit(None).cast("string") if self.note is None else self.note
        return F.struct(
            F.lit(number).alias("check_no"),
            F.lit(check_name).alias("check_name"),
            F.coalesce(self.passed, F.lit(False)).alias("passed"),
            self.metric.cast("double").alias("metric_value"),
            note.alias("metric_note"),
            F.lit(float(self.threshold)).alias("threshold_value"),
            self.message.alias("message"),
            F.lit(table).alias("table_name"),
        )


class Check:
    check_name: str

    def measures(self, as_of: Column) -> dict[str, Column]:
        """Aggregates this check needs; the row count is always measured."""
        return {}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        raise NotImplementedError


def _rate_verdict(
    part: Column, rows: Column, max_rate: float, what: str, table: str
) -> Verdict:
    empty = rows == 0
    rate = part / F.nullif(rows, F.lit(0))
    # Rounds the double as it is, as printf of C does; %f of Java rounds its shortest spelling.
    shown = F.call_function("format_number", rate, F.lit("0.000000"))
    return Verdict(
        passed=rate <= F.lit(float(max_rate)),
        metric=F.round(rate, 6),
        threshold=max_rate,
        note=F.when(empty, F.lit("empty_dataframe")),
        message=F.when(empty, F.lit(f"{table} is empty, no {what}")).otherwise(
            F.concat(F.lit(f"{what} is "), shown, F.lit(f", at most {max_rate:.6f} allowed"))
        ),
    )


@dataclass(frozen=True)
class NullRate(Check):
    """Share of rows in which ``column`` is NULL."""

    column: str
    max_rate: float = 0.0
    check_name = "check_null_rate"

    def measures(self, as_of: Column) -> dict[str, Column]:
        return {"nulls": F.count_if(F.col(self.column).isNull())}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        what = f"null rate of {self.column}"
        return _rate_verdict(measured["nulls"], measured[ROWS], self.max_rate, what, table)


@dataclass(frozen=True)
class DuplicateRate(Check):
    """Share of rows beyond the first of each key; NULL counts as a key value."""

    keys: tuple[str, ...]
    max_rate: float = 0.0
    check_name = "check_duplicate_rate"

    def measures(self, as_of: Column) -> dict[str, Column]:
        return {"distinct": F.count_distinct(F.struct(*self.keys))}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        rows = measured[ROWS]
        what = f"duplicate rate on {', '.join(self.keys)}"
        return _rate_verdict(rows - measured["distinct"], rows, self.max_rate, what, table)


@dataclass(frozen=True)
class RowCount(Check):
    min_rows: int = 1
    check_name = "check_row_count"

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        rows = measured[ROWS]
        return Verdict(
            passed=rows >= self.min_rows,
            metric=rows,
            threshold=self.min_rows,
            message=F.format_string(f"{table} has %d rows, at least {self.min_rows} expected", rows),
        )


def _violations(count: Column, what: str) -> Verdict:
    return Verdict(
        passed=count == 0,
        metric=count,
        threshold=0,
        message=F.format_string(f"%d rows {what}", count),
    )


@dataclass(frozen=True)
class ValueRange(Check):
    """Every value that is not NULL lies in the closed range; None leaves a side open."""

    column: str
    min_value: float | int | None = None
    max_value: float | int | None = None
    check_name = "check_value_range"

    def measures(self, as_of: Column) -> dict[str, Column]:
        value, outside = F.col(self.column), F.lit(False)
        if self.min_value is not None:
            outside = outside | (value < self.min_value)
        if self.max_value is not None:
            outside = outside | (value > self.max_value)
        return {"outside": F.count_if(outside)}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        what = f"with {self.column} outside [{self.min_value}, {self.max_value}]"
        return _violations(measured["outside"], what)


@dataclass(frozen=True)
class AllowedValues(Check):
    """Every value that is not NULL is one of a fixed set."""

    column: str
    values: tuple[Any, ...]
    check_name = "check_allowed_values"

    def measures(self, as_of: Column) -> dict[str, Column]:
        return {"unknown": F.count_if(~F.col(self.column).isin(list(self.values)))}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        what = f"with {self.column} not in {', '.join(map(str, self.values))}"
        return _violations(measured["unknown"], what)


@dataclass(frozen=True)
class Freshness(Check):
    """Age of the newest timestamp in minutes."""

    column: str
    max_age_minutes: float
    check_name = "check_freshness"

    def measures(self, as_of: Column) -> dict[str, Column]:
        newest = F.max(F.col(self.column).cast("timestamp"))
        return {"age": (F.unix_micros(as_of) - F.unix_micros(newest)) / 60_000_000}

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        age = measured["age"]
        return Verdict(
            passed=age <= F.lit(float(self.max_age_minutes)),
            metric=F.round(age, 2),
            threshold=self.max_age_minutes,
            note=F.when(age.isNull(), F.lit("null_max_timestamp")),
            message=F.when(
                age.isNull(), F.lit(f"{table} has no timestamp in {self.column}")
            ).otherwise(
                F.format_string(
                    f"newest {self.column} is %.2f minutes old,"
                    f" at most {self.max_age_minutes} allowed",
                    age,
                )
            ),
        )


@dataclass(frozen=True)
class ForeignKey(Check):
    """Every value of ``column`` that is not NULL exists in ``parent``."""

    column: str
    parent: DataFrame
    parent_column: str
    check_name = "check_referential_integrity"

    def judge(self, table: str, measured: Mapping[str, Column]) -> Verdict:
        what = f"with {self.column} missing from parent column {self.parent_column}"
        return _violations(measured["orphans"], what)


def _key_text(child: DataFrame, key: ForeignKey) -> tuple[Column, Column]:
    """Child and parent key as text; numbers of different types are equal as numbers."""
    kinds = child.schema[key.column].dataType, key.parent.schema[key.parent_column].dataType
    sides = F.col(key.column), F.col(key.parent_column)
    if kinds[0] != kinds[1] and all(isinstance(k, T.NumericType) for k in kinds):
        sides = tuple(c.cast("decimal(38,9)") for c in sides)
    return sides[0].cast("string"), sides[1].cast("string")


def orphan_counts(child: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """One row with ``orphans_0``, ``orphans_1``, ...: the child rows that lack each parent.

    All keys go through one pass over the child: its key columns become rows tagged with the
    constraint, are counted per value, and what is left meets the tagged keys of all
    parents in one anti join. A value shared by a large part of the rows is one row there.
    """
    texts = [_key_text(child, key) for key in keys]
    tagged = F.array(*[F.struct(F.lit(k).alias("_fk"), c.alias("_key")) for k, (c, _) in enumerate(texts)])
    counted = (
        child.select(F.inline(tagged)).filter("_key IS NOT NULL").groupBy("_fk", "_key").agg(F.count(F.lit(1)).alias("_n"))
    )
    held = [
        key.parent.select(F.lit(k).alias("_fk"), p.alias("_key"))
        for k, (key, (_, p)) in enumerate(zip(keys, texts, strict=True))
    ]
    lacking = counted.join(functools.reduce(DataFrame.unionByName, held), ["_fk", "_key"], "left_anti")
    sums = [F.sum(F.when(F.col("_fk") == k, F.col("_n"))) for k in range(len(keys))]
    return lacking.agg(*[F.coalesce(n, F.lit(0)).alias(f"orphans_{k}") for k, n in enumerate(sums)])


# Check names and argument names of suites given as plain dictionaries.
_CONFIG: dict[str, tuple[Callable[..., Check], Sequence[str]]] = {
    "null_rate": (NullRate, ("column_name", "max_null_rate")),
    "duplicate_rate": (
        lambda keys, max_rate: DuplicateRate(tuple(keys), max_rate),
        ("key_columns", "max_duplicate_rate"),
    ),
    "row_count": (RowCount, ("min_row_count",)),
    "value_range": (ValueRange, ("column_name", "min_value", "max_value")),
    "freshness": (Freshness, ("timestamp_column", "max_age_minutes")),
    "referential_integrity": (
        ForeignKey,
        ("child_key_column", "parent_dataframe", "parent_key_column"),
    ),
}


def check_from_config(config: Mapping[str, Any]) -> Check:
    """Build a check from a dictionary with ``check_type`` and its arguments."""
    kind = config["check_type"]
    if kind not in _CONFIG:
        raise ValueError(f"unknown check type {kind!r}, expected one of {sorted(_CONFIG)}")
    build, names = _CONFIG[kind]
    # A side of a range that is not named is open.
    open_sides = dict.fromkeys(("min_value", "max_value"))
    return build(*[(open_sides | config)[name] for name in names])
