"""Columns of the daily snapshot that follow from the days before: plan runs, upgrades, downgrades."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.merge import conform
from ..schemas import FACT_SUBSCRIPTION_DAILY


def day_of(key: str) -> Column:
    return F.to_date(F.col(key).cast("string"), "yyyyMMdd")


def with_lifecycle(
    daily: DataFrame, accounts: DataFrame, plans: DataFrame, before: DataFrame | None = None
) -> DataFrame:
    """Daily snapshots with `days_since_signup`, `days_on_current_plan`, `is_expansion`, `is_contraction`.

    A plan run is a stretch of days on which the account has a snapshot with the same plan; its first day
    counts as day 1, a day without a snapshot ends it. An account expands (contracts) on a day if its plan
    has a higher (lower) tier than that of the day before; a plan without a tier does neither.
    Accounts without a signup date have no days since it; before the signup they are negative.

    `before` holds the stored snapshots of the day before the period: the runs go on from their
    `days_on_current_plan` (where that is empty, from 1). So a period gives the same rows whether it is
    built at once or day by day, and a new day reads one old day. An account has one row a day, hence
    no partition here outgrows the period.
    """
    rows = daily.withColumn("_so_far", F.lit(None).cast("int"))
    if before is not None:
        old = before.select(*daily.columns, F.coalesce("days_on_current_plan", F.lit(1)).alias("_so_far"))
        rows = rows.unionByName(old)
    tiers = plans.select("plan_key", F.col("plan_tier").alias("_tier"))
    signed = accounts.select("account_key", F.col("signup_date").cast("date").alias("_signed"))
    rows = rows.withColumn("_day", day_of("date_key")).join(tiers, "plan_key", "left").join(signed, "account_key", "left")

    account = Window.partitionBy("account_key").orderBy("_day")
    follows = F.datediff("_day", F.lag("_day").over(account)) == 1
    same_plan = follows & (F.lag("plan_key").over(account) == F.col("plan_key"))
    change = F.when(follows, F.col("_tier") - F.lag("_tier").over(account))
    begun = F.when(F.col("_so_far").isNotNull(), F.date_sub("_day", F.col("_so_far") - 1))
    begun = begun.when(~F.coalesce(same_plan, F.lit(False)), F.col("_day"))
    runs = rows.withColumns({"_begun": begun, "_change": change})
    since = F.last("_begun", ignorenulls=True).over(account.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = runs.withColumns(
        {
            "days_since_signup": F.datediff("_day", "_signed"),
            "days_on_current_plan": F.datediff("_day", since) + 1,
            "is_expansion": F.coalesce(F.col("_change") > 0, F.lit(False)),
            "is_contraction": F.coalesce(F.col("_change") < 0, F.lit(False)),
        }
    )
    return conform(filled.where("_so_far IS NULL"), FACT_SUBSCRIPTION_DAILY)


def stored_before(snapshots: DataFrame, first_day: date) -> DataFrame:
    """Stored snapshots of the day before `first_day`: one partition."""
    day = first_day - timedelta(days=1)
    return snapshots.where(F.col("date_key") == day.year * 10000 + day.month * 100 + day.day)
