"""Parsing of dates and numbers from whatever type the source delivered.

Each row is read by itself: one odd value never changes how its neighbours are read. Dates are
ISO 8601. None of these depends on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ..schemas import MONEY


def _is_temporal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DateType, TimestampType, TimestampNTZType))


def parse_moment(df: DataFrame, name: str) -> Column:
    """Timestamp of a column; unreadable values become null."""
    if _is_temporal(df, name):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name).try_cast("timestamp_ntz")


def parse_moment_strict(df: DataFrame, name: str) -> Column:
    """Timestamp of a column; an unreadable value fails the job, null stays null."""
    if _is_temporal(df, name):
        return F.col(name).cast("timestamp_ntz")
    parsed = F.col(name).try_cast("timestamp_ntz")
    complaint = F.concat(F.lit(f"unreadable timestamp in {name}: "), F.col(name).cast("string"))
    return F.when(F.col(name).isNotNull() & parsed.isNull(), F.raise_error(complaint)).otherwise(parsed)


def parse_money(name: str) -> Column:
    """Amount with two decimals; text that is no plain number becomes null.

    Going through a wide decimal rather than a double keeps cents exact and refuses
    forms such as '5d' or 'inf'.
    """
    return F.col(name).try_cast("decimal(18,2)").try_cast(MONEY)
