"""The star schema: three dimensions, one snapshot fact, one event fact.

Every function maps DataFrames to a DataFrame and takes its clock as an argument. Columns the
model declares without a rule to fill them stay at their defaults.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_key
from ..operators.dedup import keep_last
from ..operators.keys import with_dense_keys
from ..operators.lookup import skew_safe_lookup
from ..operators.merge import conform, rows_not_in
from ..schemas import (
    CALENDAR_FIRST_DAY,
    CALENDAR_LAST_DAY,
    DEFAULT_COMPANY_SIZE,
    DEFAULT_COUNTRY,
    DEFAULT_INDUSTRY,
    DEFAULT_PLAN_KEY,
    DIM_ACCOUNT,
    DIM_DATE,
    DIM_PLAN,
    FACT_SUBSCRIPTION_DAILY,
    FACT_USER_EVENTS,
    PLAN_TIERS,
    SNAPSHOT_DAYS_BACK,
)


def dim_date(
    spark: SparkSession, first: str = CALENDAR_FIRST_DAY, last: str = CALENDAR_LAST_DAY
) -> DataFrame:
    """One row per day. Weeks are ISO weeks, the fiscal year is the calendar year, and day and
    month names are padded with blanks to nine characters."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    day = F.col("full_date")
    week, month, quarter = (F.trunc(day, unit) for unit in ("week", "month", "quarter"))
    month_end = F.last_day(day)
    quarter_end = F.date_sub(F.add_months(quarter, 3), 1)
    iso_day = F.weekday(day) + 1
    columns = {
        "date_key": date_key(day),
        "day_of_week": iso_day,
        "day_of_week_name": F.rpad(F.date_format(day, "EEEE"), 9, " "),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "week_start_date": week,
        "week_end_date": F.date_add(week, 6),
        "month_number": F.month(day),
        "month_name": F.rpad(F.date_format(day, "MMMM"), 9, " "),
        "month_start_date": month,
        "month_end_date": month_end,
        "quarter_number": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year_number": F.year(day),
        "fiscal_year": F.year(day),
        "fiscal_quarter": F.quarter(day),
        "is_weekend": iso_day >= 6,
        "is_month_end": day == month_end,
        "is_quarter_end": day == quarter_end,
        "is_year_end": F.dayofyear(F.date_add(day, 1)) == 1,
    }
    days = spark.range(1).select(F.explode(span).alias("full_date"))
    return conform(days.withColumns(columns), DIM_DATE)


def dim_plan(spark: SparkSession, run_ts: datetime | None = None) -> DataFrame:
    """The seeded plan tiers, as literals: Spark then knows the table is tiny and broadcasts it."""

    def literal(value: object) -> str:
        return "NULL" if value is None else f"'{value}'"

    rows = ", ".join(f"({', '.join(map(literal, tier))})" for tier in PLAN_TIERS)
    seeded = [c for c in DIM_PLAN.names if c not in ("is_active", "created_at", "updated_at")]
    plans = spark.sql(f"SELECT * FROM VALUES {rows} AS plans({', '.join(seeded)})")
    now = F.lit(run_ts).cast("timestamp_ntz")
    return conform(
        plans.withColumns({"is_active": F.lit(True), "created_at": now, "updated_at": now}), DIM_PLAN
    )


def dim_account(
    profiles: DataFrame,
    run_ts: datetime | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Accounts to add: one per user of the profiles that `existing` does not hold yet.

    Keys continue after the highest key in use, in order of the account id.
    """
    now = F.lit(run_ts).cast("timestamp_ntz")
    user = F.col("user_id")
    accounts = (
        profiles.where(user.isNotNull())
        .select(
            user.alias("account_id"),
            F.concat(F.lit("Company "), F.left(user, F.lit(8))).alias("company_name"),
            F.coalesce("industry", F.lit(DEFAULT_INDUSTRY)).alias("industry"),
            F.coalesce("company_size", F.lit(DEFAULT_COMPANY_SIZE)).alias("company_size"),
            F.coalesce("country", F.lit(DEFAULT_COUNTRY)).alias("country"),
            F.lit("active").alias("status"),
            F.col("created_at").alias("signup_date"),
        )
        .distinct()
    )
    start = 1
    if existing is not None:
        accounts = rows_not_in(existing, accounts, ["account_id"])
        highest = existing.agg(F.max("account_key")).first()[0]
        start = 1 + (highest or 0)
    keyed = with_dense_keys(accounts, "account_id", "account_key", start)
    return conform(keyed.withColumns({"created_at": now, "updated_at": now}), DIM_ACCOUNT)


def fact_user_events(
    events: DataFrame,
    profiles: DataFrame,
    dates: DataFrame,
    run_ts: datetime | None = None,
    existing: DataFrame | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Events inside the calendar with the country of their user, minus those already held.

    `event_key` is left empty: a sequence over all events would serialise the load, so the
    warehouse numbers rows as it writes them.
    """
    keyed = events.drop("country").withColumn("date_key", date_key(F.col("event_ts")))
    inside = keyed.join(dates.select("date_key"), "date_key", "left_semi")
    if existing is not None:
        inside = rows_not_in(existing, inside, ["event_id"])
    located = skew_safe_lookup(inside, profiles, "user_id", ["country"], "event_id", hot_from)
    return conform(
        located.withColumnRenamed("event_ts", "event_timestamp").withColumns(
            {
                "is_activation_event": F.lit(False),
                "is_engagement_event": F.lit(False),
                "loaded_at": F.lit(run_ts).cast("timestamp_ntz"),
            }
        ),
        FACT_USER_EVENTS,
    )


def fact_subscription_daily(
    subscriptions: DataFrame,
    accounts: DataFrame,
    plans: DataFrame,
    dates: DataFrame,
    as_of: date,
    days_back: int = SNAPSHOT_DAYS_BACK,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per account and day for the days up to `as_of`, `as_of` included.

    The subscription started last represents the account on a day (ties: highest id). MRR is the
    list price of its plan whatever its status; unknown plans count as the first plan at no
    price. A cancelled or expired subscription is marked churned on each of its days.

    The days are those of `dates` in the period. Subscriptions are cut to the first and last of
    these days that they cover. Among subscriptions of one user that cover the same days only the
    one started last can ever represent the account, so the others are dropped before days are
    spelled out. With D days that leaves at most D(D+1)/2 rows per user (one per distinct stretch)
    however many subscriptions the user has and however long the period is, and only then do rows
    meet by user. Days are spelled out after that shuffle, not before it.
    """
    low, high = as_of - timedelta(days=days_back), as_of
    calendar = dates.where(F.col("full_date").between(F.lit(low), F.lit(high)))
    days = sorted(row["full_date"] for row in calendar.select("full_date").collect())  # one per day
    held_days = F.array(*[F.lit(day) for day in days]).cast("array<date>")
    first = F.greatest(F.col("start_date").cast("date"), F.lit(low))
    last = F.least(F.coalesce(F.col("end_date").cast("date"), F.lit(high)), F.lit(high))
    spans = (
        subscriptions.where(F.col("user_id").isNotNull() & F.col("start_date").isNotNull())
        .select(
            "user_id",
            "subscription_id",
            "status",
            "start_date",
            F.lower("plan_name").alias("plan_id"),
            first.alias("first_day"),
            last.alias("last_day"),
        )
        .where("first_day <= last_day")
        .withColumns(
            {
                "before": F.size(F.filter(held_days, lambda day: day < F.col("first_day"))),
                "until": F.size(F.filter(held_days, lambda day: day <= F.col("last_day"))),
            }
        )
        .where("before < until")
        .drop("first_day", "last_day")
    )
    newest = ["start_date", "subscription_id"]
    per_stretch = keep_last(spans, ["user_id", "before", "until"], newest)
    held = per_stretch.join(
        accounts.select(F.col("account_id").alias("user_id"), "account_key"), "user_id"
    )
    covered = F.slice(held_days, F.col("before") + 1, F.col("until") - F.col("before"))
    daily = held.withColumn("full_date", F.explode(covered))
    current = keep_last(daily, ["user_id", "full_date"], newest)
    priced = current.join(
        plans.select("plan_id", "plan_key", "monthly_price"), "plan_id", "left"
    )
    price = F.coalesce("monthly_price", F.lit(Decimal("0.00")))
    return conform(
        priced.select(
            date_key(F.col("full_date")).alias("date_key"),
            "account_key",
            F.coalesce("plan_key", F.lit(DEFAULT_PLAN_KEY)).alias("plan_key"),
            F.col("status").alias("subscription_status"),
            price.alias("mrr"),
            (price * 12).alias("arr"),
            F.lit(0).alias("active_users"),
            F.lit(0).alias("total_events"),
            (F.col("start_date").cast("date") == F.col("full_date")).alias("is_new_subscription"),
            F.col("status").isin("cancelled", "expired").alias("is_churned"),
            F.lit(False).alias("is_expansion"),
            F.lit(False).alias("is_contraction"),
            F.lit(run_ts).cast("timestamp_ntz").alias("loaded_at"),
        ),
        FACT_SUBSCRIPTION_DAILY,
    )


def snapshot_totals(snapshots: DataFrame, as_of: date) -> DataFrame:
    """Snapshot rows and MRR of one day."""
    key = as_of.year * 10000 + as_of.month * 100 + as_of.day
    return snapshots.where(F.col("date_key") == key).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.coalesce(F.sum("mrr"), F.lit(0).cast("decimal(20,2)")).alias("total_mrr"),
    )


def mrr_per_day(snapshots: DataFrame) -> DataFrame:
    """Snapshot rows and MRR of every day held: the MRR as of any date."""
    return (
        snapshots.groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("snapshots"), F.sum("mrr").alias("total_mrr"))
        .orderBy("date_key")
    )


def mrr_by_month(snapshots: DataFrame, dates: DataFrame) -> DataFrame:
    """MRR and accounts of active subscriptions at each month end."""
    month_ends = dates.where("is_month_end").select("date_key", "year_number", "month_number")
    return (
        snapshots.where(F.col("subscription_status") == "active")
        .join(month_ends, "date_key")
        .groupBy("year_number", "month_number")
        .agg(
            F.sum("mrr").alias("total_mrr"),
            F.count_distinct("account_key").alias("active_accounts"),
        )
        .orderBy("year_number", "month_number")
    )


def daily_active_users(events: DataFrame, dates: DataFrame, as_of: date) -> DataFrame:
    """Users and events per day and event type since 30 days before `as_of`."""
    since = F.lit(as_of - timedelta(days=SNAPSHOT_DAYS_BACK))
    days = dates.where(F.col("full_date") >= since).select("date_key", "full_date")
    return (
        events.join(days, "date_key")
        .groupBy("full_date", "event_type")
        .agg(
            F.count_distinct("user_id").alias("unique_users"),
            F.count(F.lit(1)).alias("total_events"),
        )
        .orderBy("full_date", F.desc("total_events"), "event_type")
    )
