"""What users do around a change of plan: features used before, sessions, conversion of trials, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_last
from ..operators.funnel import funnel, quantiles

SESSION_GAP = "30 minutes"
NO_PLAN = "none"


def feature_before_upgrade(
    events: DataFrame, transactions: DataFrame, feature_path: str = "$.feature"
) -> DataFrame:
    """Completed upgrades with the feature the user used last before, and when that was.

    A feature is the value at `feature_path` of the properties of a `feature_used` event, as text; an
    event without one counts nothing. Of events at one time the one with the highest id counts.
    """
    path = feature_path.replace("'", "\\'")
    used = events.where("event_type = 'feature_used'").withColumn(
        "feature", F.expr(f"try_variant_get(try_parse_json(properties), '{path}', 'string')")
    )
    upgrades = transactions.where("transaction_type = 'upgrade' AND status = 'completed'")
    return asof_last(
        upgrades.select("transaction_id", "user_id", "transaction_date"),
        used.where("feature IS NOT NULL"),
        "user_id", "transaction_date", "event_ts", "event_id",
        {"last_feature": "feature", "last_used_at": "event_ts"},
        strictly=True,
    )


def features_before_upgrades(upgrades: DataFrame, within_days: int | None = None) -> DataFrame:
    """Upgrades and users by the feature used last before, with the days between.

    `upgrades` come from `feature_before_upgrade`; those without a feature stand under null. With
    `within_days` a feature used longer ago counts as none.
    """
    days = F.datediff("transaction_date", "last_used_at")
    rows = upgrades.withColumn("days", days)
    if within_days is not None:
        recent = F.col("days") <= within_days
        rows = rows.withColumns({"last_feature": F.when(recent, F.col("last_feature")), "days": F.when(recent, F.col("days"))})
    return rows.groupBy("last_feature").agg(
        F.count(F.lit(1)).alias("upgrades"),
        F.count_distinct("user_id").alias("users"),
        F.min("days").alias("fewest_days"),
        F.max("days").alias("most_days"),
    )


def sessions(events: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """(user_id, session_id, started, ended, events) of every session.

    Events with a session id belong to that session of their user. Events of a user without one
    belong together while at most `gap` lies between neighbours, over midnight too; such a session has
    no id. Events with neither user nor session id belong to none. Sessions of a task are merged before
    the shuffle where `spark.sql.sessionWindow.merge.sessions.in.local.partition` is on (`session.py`).
    """
    measures = [F.min("event_ts").alias("started"), F.max("event_ts").alias("ended"), F.count(F.lit(1)).alias("events")]
    named = events.where("session_id IS NOT NULL").groupBy("user_id", "session_id").agg(*measures)
    window = F.session_window("event_ts", gap)
    found = events.where("session_id IS NULL AND user_id IS NOT NULL").groupBy("user_id", window.alias("w")).agg(*measures)
    columns = ["user_id", "session_id", "started", "ended", "events"]
    return named.select(*columns).unionByName(found.withColumn("session_id", F.lit(None).cast("string")).select(*columns))


def sessions_by_plan(events: DataFrame, subscriptions: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Sessions, users, events and duration in seconds by the plan in force when a session began.

    That is the plan of the subscription the user began last (ties: highest id), if it had not ended.
    """
    started = asof_last(
        sessions(events, gap), subscriptions, "user_id", "started", "start_date", "subscription_id",
        {"plan_name": "plan_name", "end_date": "end_date"},
    )
    in_force = F.col("end_date").isNull() | (F.col("end_date") >= F.col("started"))
    micros = F.expr("unix_micros(CAST(ended AS TIMESTAMP)) - unix_micros(CAST(started AS TIMESTAMP))")
    plan = F.coalesce(F.when(in_force, F.lower("plan_name")), F.lit(NO_PLAN))
    return (
        started.select(plan.alias("plan"), "user_id", "events", micros.alias("micros"))
        .groupBy("plan")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.count_distinct("user_id").alias("users"),
            F.sum("events").alias("events"),
            F.round(F.sum("micros") / F.count(F.lit(1)) / 1e6, 3).alias("avg_seconds"),
            F.round(F.max("micros") / 1e6, 3).alias("max_seconds"),
        )
    )


def trial_conversion(profiles: DataFrame, subscriptions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Trials, those that came to pay, and the days that took, by signup source.

    A user's trial begins with the first trial subscription; the first completed payment on that day
    or later converts it. Users without a profile have no source.
    """
    trials = subscriptions.where("status = 'trial'").select("user_id", F.col("start_date").alias("day"))
    paid = transactions.where("transaction_type = 'payment' AND status = 'completed'")
    reached = funnel([trials, paid.select("user_id", F.col("transaction_date").alias("day"))], "user_id")
    users = reached.select("user_id", F.datediff(F.get("days", F.lit(1)), F.get("days", F.lit(0))).alias("days"))
    sourced = users.join(profiles.select("user_id", "signup_source"), "user_id", "left")
    totals = sourced.groupBy("signup_source").agg(
        F.count(F.lit(1)).alias("trials"),
        F.count("days").alias("converted"),
        F.round(F.count("days") * 100.0 / F.count(F.lit(1)), 2).cast("double").alias("conversion_rate"),
    )
    days = quantiles(sourced, ["signup_source"], "days", {"median_days": 0.5, "p90_days": 0.9})
    days = days.withColumnRenamed("signup_source", "_source")
    return totals.join(days, F.col("signup_source").eqNullSafe(F.col("_source")), "left").drop("_source")


def revenue_retention(snapshots: DataFrame, accounts: DataFrame, plans: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue of each month end's accounts one month later, in total and by segment.

    Only active subscriptions have revenue. An account without any at a month end but at the next is new
    and counts in no rate. Months whose next month end is not held are left out. Segments are the
    industry, company size and country of the account and its plan at the first month end, all from one pass.
    `nrr` is what is left of the starting revenue after expansion, contraction and churn.
    """
    ends = dates.where("is_month_end").select("date_key", "month_start_date")
    held = snapshots.where("subscription_status = 'active' AND mrr > 0").join(ends, "date_key")
    held = held.join(plans.select("plan_key", F.col("plan_id").alias("plan")), "plan_key", "left")
    first = held.select("account_key", F.col("month_start_date").alias("month"), F.col("mrr").alias("before"), "plan")
    later = held.select("account_key", F.add_months("month_start_date", -1).alias("month"), F.col("mrr").alias("after"))
    # Months with both ends among all snapshots: at most one row for each month of the calendar.
    months = snapshots.select("date_key").distinct().join(ends, "date_key").select(F.col("month_start_date").alias("month"))
    whole = months.join(months.select(F.add_months("month", -1).alias("month")), "month", "left_semi")

    pairs = first.join(later, ["account_key", "month"], "full").join(whole, "month", "left_semi")
    pairs = pairs.join(accounts.select("account_key", "industry", "company_size", "country"), "account_key", "left")
    pairs = pairs.withColumns({"before": F.coalesce("before", F.lit(0)), "after": F.coalesce("after", F.lit(0))})
    names = ["industry", "company_size", "country", "plan"]
    sets = [[F.col("month")], *[[F.col("month"), F.col(n)] for n in names]]
    old, up = F.col("before") > 0, F.col("after") - F.col("before")

    def total(amount, where):
        return F.coalesce(F.sum(F.when(where, amount)), F.lit(0).cast("decimal(20,2)"))

    grouped = pairs.groupingSets(sets, F.col("month"), *[F.col(n) for n in names]).agg(
        F.grouping_id("month", *names).alias("_set"),
        F.count(F.when(old, 1)).alias("accounts"),
        F.count(F.when(old & (F.col("after") == 0), 1)).alias("churned_accounts"),
        total(F.col("before"), old).alias("starting_mrr"),
        total(up, old & (up > 0)).alias("expansion_mrr"),
        total(-up, old & (up < 0) & (F.col("after") > 0)).alias("contraction_mrr"),
        total(F.col("before"), old & (F.col("after") == 0)).alias("churned_mrr"),
        total(F.col("after"), ~old).alias("new_mrr"),
    )
    kept = (F.col("starting_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churned_mrr")).cast("double")
    segment = F.when(F.col("_set") == 15, "all").when(F.col("_set") == 7, "industry").when(F.col("_set") == 11, "company_size")
    segment = segment.when(F.col("_set") == 13, "country").otherwise("plan")
    return grouped.select(
        "month",
        segment.alias("segment"),
        F.coalesce(*names).alias("value"),
        "accounts", "churned_accounts", "starting_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "new_mrr",
        F.when(F.col("starting_mrr") > 0, F.round(kept / F.col("starting_mrr").cast("double"), 6)).alias("nrr"),
        F.when(F.col("accounts") > 0, F.round(F.col("churned_accounts") / F.col("accounts"), 6)).alias("churn_rate"),
    )
