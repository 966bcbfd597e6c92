"""Data-quality checks as aggregates.

A check says which table it reads and how its result follows from aggregates over that table.
Checks that only need aggregates of a table share one pass over it; uniqueness and reference
checks take a grouping or a join of their own. Every result is a row of `RESULT_COLUMNS`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = [
    "check_name", "table_name", "passed", "expected", "actual", "message", "severity",
]
REPORTED_DUPLICATE_GROUPS = 10

Tables = Callable[[str], DataFrame]


def _text(*parts: Any) -> Column:
    return F.concat(
        *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    )


def _fixed(number: Column, digits: int) -> Column:
    """A number with a fixed count of decimals and no thousands separator."""
    return F.format_string(f"%.{digits}f", number)


def _result(
    check: "Check", passed: Column, expected: Any, actual: Any, message: Any, severity: Any = None
) -> Column:
    def text(value: Any) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        passed.alias("passed"),
        text(expected).alias("expected"),
        text(actual).alias("actual"),
        text(message).alias("message"),
        text(check.severity if severity is None else severity).alias("severity"),
    )


@dataclass(frozen=True)
class Check:
    table: str
    severity: str = field(default="error", kw_only=True)
    name = ""
    # Name under which a check that could not run is reported.
    function = ""

    def result(self, df: DataFrame, tables: Tables) -> Column:
        """The result row as an expression over aggregates of `df`."""
        raise NotImplementedError

    def frame(self, df: DataFrame, tables: Tables) -> DataFrame:
        """The rows the result aggregates; the table itself where checks can share a pass."""
        return df

    @property
    def shares_pass(self) -> bool:
        return type(self).frame is Check.frame


@dataclass(frozen=True)
class RowCount(Check):
    min_count: int = 1
    max_count: int | None = None
    name = "row_count"
    function = "check_row_count"

    def result(self, df: DataFrame, tables: Tables) -> Column:
        n = F.count(F.lit(1))
        passed = n >= self.min_count
        if self.max_count is not None:
            passed = passed & (n <= self.max_count)
        # An upper bound of 0 is enforced, yet left out of the text.
        upper = f" and <= {self.max_count}" if self.max_count else ""
        expected = f">= {self.min_count}{upper}"
        message = _text("Found ", F.format_number(n, 0), f" rows (expected {expected})")
        return _result(self, passed, expected, n.cast("string"), message)


@dataclass(frozen=True)
class NullRate(Check):
    """Share of null cells over all listed columns, in percent."""

    columns: tuple[str, ...]
    max_null_pct: float = 0.0
    name = "null_values"
    function = "check_null_values"

    def result(self, df: DataFrame, tables: Tables) -> Column:
        rows = F.count(F.lit(1))
        nulls = sum((F.count_if(F.col(c).isNull()) for c in self.columns), F.lit(0))
        cells = F.nullif(rows * len(self.columns), F.lit(0))
        pct = nulls / cells * 100
        expected = f"<= {self.max_null_pct}%"
        empty = rows == 0
        shown = _text(_fixed(pct, 2), "%")
        message = _text(
            f"Columns {list(self.columns)}: ", shown, f" null (expected {expected})"
        )
        return _result(
            self,
            F.when(empty, True).otherwise(pct <= self.max_null_pct),
            expected,
            F.when(empty, "0%").otherwise(shown),
            F.when(empty, "Table is empty, no nulls possible").otherwise(message),
            F.when(empty, "info").otherwise(self.severity),
        )


@dataclass(frozen=True)
class Unique(Check):
    """No two rows share the values of the columns; null is a value here.

    The report states at most `REPORTED_DUPLICATE_GROUPS` groups; `duplicate_groups` counts them all.
    """

    columns: tuple[str, ...]
    name = "no_duplicates"
    function = "check_duplicates"

    def frame(self, df: DataFrame, tables: Tables) -> DataFrame:
        return df.groupBy(*self.columns).count()

    def result(self, df: DataFrame, tables: Tables) -> Column:
        groups = F.least(F.count_if(F.col("count") > 1), F.lit(REPORTED_DUPLICATE_GROUPS))
        passed = groups == 0
        shown = F.when(passed, "No duplicates").otherwise(_text(groups, "+ duplicate groups"))
        return _result(
            self,
            passed,
            "0 duplicates",
            _text(groups, " duplicate groups found"),
            _text(f"Columns {list(self.columns)}: ", shown),
        )


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of groups of rows that share the values of the columns, without an upper limit."""
    groups = df.groupBy(*columns).count().where("count > 1")
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups"))


@dataclass(frozen=True)
class Reference(Check):
    """Every non-null value exists in the referenced column. Counts distinct values without one.

    Both sides are reduced to distinct values first, so a value that fills much of either table
    is one row by the time it is shuffled for the join.
    """

    column: str
    reference_table: str
    reference_column: str
    name = "referential_integrity"
    function = "check_referential_integrity"

    def frame(self, df: DataFrame, tables: Tables) -> DataFrame:
        used = df.select(F.col(self.column).alias("v")).where("v is not null").distinct()
        known = (
            tables(self.reference_table)
            .select(F.col(self.reference_column).alias("v"))
            .where("v is not null")
            .distinct()
        )
        return used.join(known, "v", "left_anti")

    def result(self, df: DataFrame, tables: Tables) -> Column:
        orphans = F.count(F.lit(1))
        link = f"{self.table}.{self.column} -> {self.reference_table}.{self.reference_column}"
        return _result(
            self,
            orphans == 0,
            "0 orphaned records",
            _text(orphans, " orphaned values"),
            _text(f"{link}: ", orphans, " orphaned"),
        )


@dataclass(frozen=True)
class Values(Check):
    """Non-null values lie in a set, or else within inclusive bounds."""

    column: str
    min_value: Any = None
    max_value: Any = None
    allowed_values: tuple[Any, ...] | None = None
    name = "value_range"
    function = "check_value_range"

    def result(self, df: DataFrame, tables: Tables) -> Column:
        value = F.col(self.column)
        if self.allowed_values:
            outside = ~value.isin(*self.allowed_values)
            expected = f"values in {list(self.allowed_values)}"
            what = " values outside allowed set"
        else:
            bounds = []
            if self.min_value is not None:
                bounds.append(value < F.lit(self.min_value))
            if self.max_value is not None:
                bounds.append(value > F.lit(self.max_value))
            if not bounds:
                return _result(
                    self,
                    F.count(F.lit(1)) >= 0,
                    "No constraints specified",
                    "N/A",
                    "No range constraints provided",
                    "info",
                )
            outside = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
            expected = f"{self.min_value} <= {self.column} <= {self.max_value}"
            what = " values out of range"
        violations = F.count_if(outside)
        passed = violations == 0
        actual = _text(violations, what)
        message = F.when(passed, f"{self.column}: All values in range").otherwise(
            _text(f"{self.column}: ", actual)
        )
        return _result(self, passed, expected, actual, message)


@dataclass(frozen=True)
class Freshness(Check):
    """The latest timestamp is at most so many hours before `now`. No timestamp at all fails."""

    column: str
    now: datetime
    max_age_hours: float = 24
    severity: str = field(default="warning", kw_only=True)
    name = "freshness"
    function = "check_freshness"

    def result(self, df: DataFrame, tables: Tables) -> Column:
        latest = F.max(F.col(self.column).cast("timestamp_ntz"))
        now = F.lit(self.now).cast("timestamp_ntz")
        hours = F.timestamp_diff("MICROSECOND", latest, now) / 3.6e9
        none = latest.isNull()
        age = _fixed(hours, 1)
        return _result(
            self,
            F.when(none, False).otherwise(hours <= self.max_age_hours),
            F.when(none, f"Data within {self.max_age_hours} hours").otherwise(
                f"<= {self.max_age_hours} hours old"
            ),
            F.when(none, "No data found").otherwise(_text(age, " hours old")),
            F.when(none, "No timestamps found in table").otherwise(
                _text("Latest record: ", latest, " (", age, "h ago)")
            ),
        )


def results_frame(checks: Sequence[tuple[int, Check]], df: DataFrame, tables: Tables) -> DataFrame:
    """Result rows of checks on one frame, computed by one aggregation of it."""
    rows = [
        F.struct(F.lit(i).alias("check_index"), check.result(df, tables).alias("r"))
        for i, check in checks
    ]
    return (
        df.agg(F.array(*rows).alias("rows"))
        .select(F.explode("rows").alias("row"))
        .select("row.check_index", *[f"row.r.{c}" for c in RESULT_COLUMNS])
    )


def null_counts(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Null count of each required column, under the given result names."""
    counts = [F.count_if(F.col(c).isNull()).alias(name) for c, name in columns.items()]
    return df.agg(*counts).select(F.lit(table).alias("table_name"), *columns.values())


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")
    )


def invalid_date_ranges(df: DataFrame, start: str, end: str) -> DataFrame:
    """Number of rows that end before they start."""
    return df.where(F.col(end) < F.col(start)).agg(F.count(F.lit(1)).alias("invalid_dates"))
