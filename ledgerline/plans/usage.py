"""Use of the product by day, kept so that longer periods need no events: sums and mergeable distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import date_key
from ..operators.merge import conform
from ..schemas import FACT_SUBSCRIPTION_DAILY

#: Log2 of the cells of a sketch: 4 kB at most, a standard error of about 1.6 %; few users are counted exactly.
CELLS = 12


def usage_by_day(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(usage_date, `by`, total_events, active_users, users) of events, for storage beside the facts.

    `active_users` is the exact number of distinct users of the day, `users` a sketch of them that
    can be merged. Events without a user count as events only. Users are made distinct map-side before
    they are counted, so that a user with a third of all events is one row for each task.
    """
    day = F.col("event_ts").cast("date").alias("usage_date")
    single = events.groupBy(day, *by, "user_id").agg(F.count(F.lit(1)).alias("_n"))
    return single.groupBy("usage_date", *by).agg(
        F.sum("_n").alias("total_events"),
        F.count("user_id").alias("active_users"),
        F.hll_sketch_agg("user_id", F.lit(CELLS)).alias("users"),
    )


def usage_of_periods(usage: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Events and estimated distinct users of periods, from stored days alone."""
    return usage.groupBy(period.alias("period"), *by).agg(
        F.sum("total_events").alias("total_events"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users_estimate"),
    )


def active_users(events: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Exact distinct users of periods: what the estimates are measured against."""
    return events.groupBy(period.alias("period"), *by).agg(F.count_distinct("user_id").alias("active_users"))


def with_usage(daily: DataFrame, accounts: DataFrame, events: DataFrame) -> DataFrame:
    """Daily snapshots with the `active_users` and `total_events` of their account on their day.

    An account's users are those its id names. Days without events have 0 of both.
    """
    keys = accounts.select("account_key", F.col("account_id").alias("user_id"))
    used = events.where("user_id IS NOT NULL").groupBy("user_id", date_key(F.col("event_ts")).alias("date_key")).agg(F.count(F.lit(1)).alias("_n"))
    used = used.join(keys, "user_id").groupBy("account_key", "date_key").agg(
        F.count(F.lit(1)).cast("int").alias("_users"), F.sum("_n").cast("int").alias("_events")
    )
    filled = daily.join(used, ["account_key", "date_key"], "left").withColumns(
        {"active_users": F.coalesce("_users", F.lit(0)), "total_events": F.coalesce("_events", F.lit(0))}
    )
    return conform(filled, FACT_SUBSCRIPTION_DAILY)
