"""Analytics questions over the warehouse tables, one function each.

Results come ordered; where a limit follows, a second sort key makes the choice definite. Time
enters through an argument. Counts of distinct users aggregate in two steps, first per group
and user on the map side, so no group is ever gathered in one place.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.lookup import skew_safe_lookup

def _rows() -> Column:
    return F.count(F.lit(1))


def _share(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded half up in decimal arithmetic; null where whole is 0."""
    exact = (part * 100).cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, digits)


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _stack(
        [
            df.agg(_rows().alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, df in tables.items()
        ]
    )


def ingestion_recency(tables: dict[str, DataFrame]) -> DataFrame:
    """Last ingestion and rows per table; each table is aggregated before the union."""
    return _stack(
        [
            df.agg(F.max("ingested_at").alias("last_ingested"), _rows().alias("total_records"))
            .select(F.lit(name).alias("table_name"), "last_ingested", "total_records")
            for name, df in tables.items()
        ]
    ).orderBy(F.desc_nulls_first("last_ingested"), "table_name")


def users_by_country(events: DataFrame, top: int = 10) -> DataFrame:
    """The countries with the most active users."""
    return (
        events.where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count_distinct("user_id").alias("active_users"), _rows().alias("total_events"))
        .orderBy(F.desc("active_users"), "country")
        .limit(top)
    )


def signup_source_share(profiles: DataFrame) -> DataFrame:
    """Users per signup source and their percentage of all users."""
    per_source = profiles.groupBy("signup_source").agg(_rows().alias("user_count"))
    total = F.sum("user_count").over(Window.partitionBy())
    return per_source.select(
        "signup_source", "user_count", _share(F.col("user_count"), total).alias("percentage")
    ).orderBy(F.desc("user_count"), "signup_source")


def events_by_type(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(_rows().alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def event_counts_by_type(events: DataFrame) -> DataFrame:
    """Dashboard form: counts only."""
    return (
        events.groupBy("event_type")
        .agg(_rows().alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def subscription_status(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.groupBy("status")
        .agg(_rows().alias("subscription_count"), F.sum("monthly_revenue").alias("total_mrr"))
        .orderBy(F.desc("subscription_count"), "status")
    )


def revenue_by_plan(subscriptions: DataFrame) -> DataFrame:
    """Active subscriptions, their revenue and average revenue per plan."""
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy("plan_name")
        .agg(
            _rows().alias("subscription_count"),
            F.sum("monthly_revenue").alias("total_mrr"),
            F.avg("monthly_revenue").alias("avg_mrr"),
        )
        .orderBy(F.desc_nulls_first("total_mrr"), "plan_name")
    )


def mrr_by_plan(subscriptions: DataFrame) -> DataFrame:
    """Dashboard form: active revenue per plan."""
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy("plan_name")
        .agg(F.sum("monthly_revenue").alias("mrr"))
        .orderBy(F.desc_nulls_first("mrr"), "plan_name")
    )


def subscription_lifecycle(subscriptions: DataFrame, now: datetime) -> DataFrame:
    """Subscriptions and revenue by whether they have ended at `now`."""
    end = F.col("end_date")
    stage = (
        F.when(end.isNull(), "Active (No End Date)")
        .when(end > F.lit(now).cast("timestamp_ntz"), "Active")
        .otherwise("Expired")
    )
    return (
        subscriptions.groupBy(stage.alias("lifecycle_status"))
        .agg(_rows().alias("count"), F.sum("monthly_revenue").alias("total_revenue"))
        .orderBy("lifecycle_status")
    )


def transactions_by_status(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("status")
        .agg(
            _rows().alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.avg("amount").alias("avg_amount"),
        )
        .orderBy(F.desc("transaction_count"), "status")
    )


def revenue_by_type(transactions: DataFrame) -> DataFrame:
    """Completed transactions and revenue per transaction type."""
    return (
        transactions.where(F.col("status") == "completed")
        .groupBy("transaction_type")
        .agg(
            _rows().alias("count"),
            F.sum("amount").alias("total_revenue"),
            F.avg("amount").alias("avg_amount"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "transaction_type")
    )


def monthly_revenue(transactions: DataFrame, months: int = 12) -> DataFrame:
    """Completed transactions and revenue of the latest months."""
    return (
        transactions.where(F.col("status") == "completed")
        .groupBy(F.trunc("transaction_date", "month").alias("month"))
        .agg(_rows().alias("transaction_count"), F.sum("amount").alias("monthly_revenue"))
        .orderBy(F.desc_nulls_first("month"))
        .limit(months)
    )


def recent_revenue(transactions: DataFrame, months: int = 6) -> DataFrame:
    """Dashboard form: revenue of the latest months under `yyyy-MM` labels."""
    return monthly_revenue(transactions, months).select(
        F.date_format("month", "yyyy-MM").alias("month"),
        F.col("monthly_revenue").alias("revenue"),
    )


def event_demographics(events: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent combinations of event type, country and signup source."""
    keys = ["event_type", "country", "signup_source"]
    return (
        events.where(F.col("country").isNotNull())
        .groupBy(*keys)
        .agg(_rows().alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("event_count"), *keys)
        .limit(top)
    )


def feature_usage_by_size(events: DataFrame) -> DataFrame:
    """Feature use per company size."""
    return (
        events.where((F.col("event_type") == "feature_used") & F.col("company_size").isNotNull())
        .groupBy("company_size")
        .agg(
            _rows().alias("feature_usage_events"),
            F.count_distinct("user_id").alias("unique_users"),
        )
        .orderBy(F.desc("feature_usage_events"), "company_size")
    )


def mrr_total(subscriptions: DataFrame) -> DataFrame:
    """Active revenue and subscriptions; no revenue counts as 0."""
    return subscriptions.where(F.col("status") == "active").agg(
        F.coalesce(F.sum("monthly_revenue"), F.lit(0).cast("decimal(20,2)")).alias("total_mrr"),
        _rows().alias("active_subscriptions"),
    )


def acquisition_by_source(profiles: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Users, subscriptions and their ratio per signup source.

    Users are counted without the join, which keeps them all. Subscriptions look up the source
    of their user by a join that splits users holding very many of them; subscriptions without
    a known user do not count.
    """
    users = profiles.groupBy("signup_source").agg(
        F.count_distinct("user_id").alias("total_users")
    )
    sources = profiles.select("user_id", "signup_source", F.lit(True).alias("known"))
    subscribed = (
        skew_safe_lookup(
            subscriptions.select("user_id", "subscription_id"),
            sources,
            "user_id",
            ["signup_source", "known"],
            "subscription_id",
        )
        .where("known")
        .groupBy("signup_source")
        .agg(F.count_distinct("subscription_id").alias("users_with_subscriptions"))
    )
    same = users["signup_source"].eqNullSafe(subscribed["signup_source"])
    found = F.coalesce("users_with_subscriptions", F.lit(0))
    return (
        users.join(subscribed, same, "left")
        .select(
            users["signup_source"],
            "total_users",
            found.alias("users_with_subscriptions"),
            _share(found, F.col("total_users")).alias("conversion_rate"),
        )
        .orderBy(F.desc("total_users"), "signup_source")
    )


def user_engagement(events: DataFrame) -> DataFrame:
    """Users, events and events per user."""
    users = F.count_distinct("user_id")
    per_user = _rows().cast("decimal(18,0)") / F.nullif(users, F.lit(0)).cast("decimal(18,0)")
    return events.agg(
        users.alias("total_users"),
        _rows().alias("total_events"),
        F.round(per_user, 2).alias("avg_events_per_user"),
    )


def last_ingested(table: DataFrame) -> DataFrame:
    return table.agg(F.max("ingested_at").alias("last_ingested"))


def mrr_list_price(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Active subscriptions at the list price of their plan; unknown plans do not count."""
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy(F.lower("plan_name").alias("plan_id"))
        .agg(_rows().alias("n"))
        .join(plans.select("plan_id", "monthly_price"), "plan_id")
        .agg(F.sum(F.col("monthly_price") * F.col("n").cast("decimal(18,0)")).alias("mrr"))
    )


def churn_rate(accounts: DataFrame, as_of: date) -> DataFrame:
    """Share of churned accounts among those that signed up before the month of `as_of`."""
    churned = F.count_if(F.col("status") == "churned")
    return accounts.where(F.col("signup_date") < F.lit(as_of.replace(day=1))).agg(
        (churned / F.nullif(_rows(), F.lit(0))).alias("churn_rate")
    )
