"""A suite of quality checks, its verdict and its report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..operators.quality import (
    RESULT_COLUMNS,
    Check,
    Freshness,
    NullRate,
    Reference,
    RowCount,
    Unique,
    Values,
    results_frame,
)
from ..schemas import SUBSCRIPTION_STATUSES

RESULT_SCHEMA = StructType(
    [StructField("check_index", IntegerType())]
    + [
        StructField(c, BooleanType() if c == "passed" else StringType())
        for c in RESULT_COLUMNS
    ]
)


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    table_name: str
    passed: bool
    expected: str
    actual: str
    message: str
    severity: str = "error"

    @property
    def status(self) -> str:
        if self.passed:
            return "PASS"
        return "WARN" if self.severity == "warning" else "FAIL"

    def __str__(self) -> str:
        verdict = "PASS" if self.passed else "FAIL"
        return f"[{verdict}] {self.check_name} on {self.table_name}: {self.message}"


class QualityError(ValueError):
    """A load that did not pass its quality suite."""


@dataclass(frozen=True)
class SuiteResult:
    suite_name: str
    run_timestamp: datetime
    results: Sequence[CheckResult]

    def _failing(self, severity: str) -> int:
        return sum(not r.passed and r.severity == severity for r in self.results)

    @property
    def total_checks(self) -> int:
        return len(self.results)

    @property
    def passed_checks(self) -> int:
        return sum(r.passed for r in self.results)

    @property
    def failed_checks(self) -> int:
        return self._failing("error")

    @property
    def warning_checks(self) -> int:
        return self._failing("warning")

    @property
    def success(self) -> bool:
        """No check of severity error failed; warnings are allowed."""
        return self.failed_checks == 0

    def summary(self) -> str:
        # The layout and marks of the report.
        marks = {"PASS": "[OK]", "WARN": "[!]", "FAIL": "[X]"}
        thick, thin = "=" * 60, "-" * 60
        totals = (
            f"Total: {self.total_checks} | Passed: {self.passed_checks} | "
            f"Failed: {self.failed_checks} | Warnings: {self.warning_checks}"
        )
        head = [f"Data Quality Suite: {self.suite_name}", f"Run at: {self.run_timestamp}"]
        body = [
            line
            for r in self.results
            for line in (f"{marks[r.status]} {r.check_name}: {r.table_name}", f"    {r.message}")
        ]
        outcome = f"Suite Result: {'PASSED' if self.success else 'FAILED'}"
        return "\n".join([thick, *head, thick, totals, thin, *body, thick, outcome, thick])

    def raise_if_failed(self) -> None:
        if not self.success:
            raise QualityError(
                f"Data quality checks failed: {self.failed_checks} error(s), "
                f"{self.warning_checks} warning(s)\n{self.summary()}"
            )


class QualitySuite:
    """Checks collected by `expect_*` calls and run together.

    `tables` gives the DataFrame of a table name. `results()` is one lazy DataFrame with a row
    per check; `run()` evaluates it and returns the verdict.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Callable[[str], DataFrame],
        suite_name: str = "Default Suite",
        now: datetime | None = None,
    ) -> None:
        self._spark, self._tables = spark, tables
        self._name, self._now = suite_name, now
        self._checks: list[Check] = []

    def _expect(self, check: Check) -> QualitySuite:
        self._checks.append(check)
        return self

    def expect_row_count(
        self, table: str, min_count: int = 1, max_count: int | None = None, severity: str = "error"
    ) -> QualitySuite:
        return self._expect(RowCount(table, min_count, max_count, severity=severity))

    def expect_no_nulls(
        self, table: str, columns: Sequence[str], severity: str = "error"
    ) -> QualitySuite:
        return self._expect(NullRate(table, tuple(columns), 0.0, severity=severity))

    def expect_null_rate(
        self, table: str, columns: Sequence[str], max_pct: float, severity: str = "warning"
    ) -> QualitySuite:
        return self._expect(NullRate(table, tuple(columns), max_pct, severity=severity))

    def expect_unique(
        self, table: str, columns: Sequence[str], severity: str = "error"
    ) -> QualitySuite:
        return self._expect(Unique(table, tuple(columns), severity=severity))

    def expect_referential_integrity(
        self,
        table: str,
        column: str,
        reference_table: str,
        reference_column: str,
        severity: str = "error",
    ) -> QualitySuite:
        return self._expect(
            Reference(table, column, reference_table, reference_column, severity=severity)
        )

    def expect_values_in_set(
        self, table: str, column: str, allowed_values: Sequence[Any], severity: str = "error"
    ) -> QualitySuite:
        return self._expect(
            Values(table, column, allowed_values=tuple(allowed_values), severity=severity)
        )

    def expect_value_range(
        self,
        table: str,
        column: str,
        min_value: Any = None,
        max_value: Any = None,
        severity: str = "error",
    ) -> QualitySuite:
        return self._expect(Values(table, column, min_value, max_value, severity=severity))

    def expect_freshness(
        self, table: str, column: str, max_age_hours: float = 24, severity: str = "warning"
    ) -> QualitySuite:
        now = self._now or datetime.now()
        return self._expect(Freshness(table, column, now, max_age_hours, severity=severity))

    def _failure(self, index: int, check: Check, error: Exception) -> DataFrame:
        row = (
            index, check.function, check.table, False, "Check to execute", str(error),
            f"Check failed to execute: {error}", "error",
        )
        return self._spark.createDataFrame([row], RESULT_SCHEMA)

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._tables(name)
        return self._read[name]

    def _alone(self, index: int, check: Check) -> DataFrame:
        """A check by itself; one that cannot even be planned becomes a failed row."""
        try:
            source = check.frame(self._table(check.table), self._table)
            return results_frame([(index, check)], source, self._table)
        except Exception as error:  # any reason a check cannot be set up is its result
            return self._failure(index, check, error)

    def _frames(self, apart: bool) -> list[DataFrame]:
        """One frame per pass over a table, or per check if they are to run `apart`."""
        self._read: dict[str, DataFrame] = {}
        shared: dict[str, list[tuple[int, Check]]] = {}
        frames = []
        for index, check in enumerate(self._checks):
            if check.shares_pass and not apart:
                shared.setdefault(check.table, []).append((index, check))
            else:
                frames.append(self._alone(index, check))
        for table, checks in shared.items():
            try:
                frames.append(results_frame(checks, self._table(table), self._table))
            except Exception:  # find out which of them it is
                frames += [self._alone(index, check) for index, check in checks]
        return frames

    def results(self) -> DataFrame:
        """A row per check in the order of the `expect_*` calls."""
        if not self._checks:
            return self._spark.createDataFrame([], RESULT_SCHEMA)
        return reduce(DataFrame.unionByName, self._frames(apart=False)).orderBy("check_index")

    def _collect_apart(self) -> list[Any]:
        rows = []
        for frame, (index, check) in zip(
            self._frames(apart=True), enumerate(self._checks), strict=True
        ):
            try:
                rows += frame.collect()
            except Exception as error:  # a check that fails while running is its result
                rows += self._failure(index, check, error).collect()
        return rows

    def run(self) -> SuiteResult:
        """Evaluate all checks in one job. If that job fails, each check runs by itself, so that
        only the failing ones are reported as such. Collects one row per check."""
        try:
            rows = self.results().collect()
        except Exception:
            rows = self._collect_apart()
        results = [CheckResult(*[row[c] for c in RESULT_COLUMNS]) for row in rows]
        return SuiteResult(self._name, self._now or datetime.now(), results)


def warehouse_suite(
    spark: SparkSession, tables: Callable[[str], DataFrame], now: datetime | None = None
) -> QualitySuite:
    """The checks every load has to pass."""
    suite = QualitySuite(spark, tables, "Warehouse Quality Suite", now)
    loaded = ["user_events", "user_profiles", "subscriptions", "transactions"]
    for table in loaded:
        suite.expect_row_count(table, min_count=1)
    # Required columns and keys per table, in this order.
    suite.expect_no_nulls("user_events", ["event_id", "user_id", "event_ts"])
    suite.expect_no_nulls("user_profiles", ["user_id", "email"])
    suite.expect_no_nulls("subscriptions", ["subscription_id", "user_id"])
    suite.expect_no_nulls("transactions", ["transaction_id", "subscription_id"])
    keys = ["event_id", "user_id", "subscription_id", "transaction_id"]
    for table, key in zip(loaded, keys, strict=True):
        suite.expect_unique(table, [key])
    suite.expect_referential_integrity("subscriptions", "user_id", "user_profiles", "user_id")
    suite.expect_referential_integrity(
        "transactions", "subscription_id", "subscriptions", "subscription_id"
    )
    suite.expect_referential_integrity("user_events", "user_id", "user_profiles", "user_id")
    suite.expect_values_in_set("subscriptions", "status", SUBSCRIPTION_STATUSES)
    suite.expect_freshness("user_events", "ingested_at", max_age_hours=48)
    return suite
