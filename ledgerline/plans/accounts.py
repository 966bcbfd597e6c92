"""Dates of an account's life that the account dimension declares: first payment, churn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the state of an account is merged: any order, late and repeated batches give the same row.
MILESTONE_RULES = {"first_paid_date": F.min, "newest": F.max}


def milestone_state(subscriptions: DataFrame, transactions: DataFrame) -> DataFrame:
    """(account_id, first_paid_date, newest) of the accounts of a batch, for `operators.merged_by`.

    `newest` is the subscription begun last (ties: highest id), as updated last.
    """
    paid = transactions.where("transaction_type = 'payment' AND status = 'completed' AND user_id IS NOT NULL")
    begun = subscriptions.where("user_id IS NOT NULL AND start_date IS NOT NULL")
    newest = F.struct("start_date", "subscription_id", "updated_at", "status", "end_date")
    first = paid.groupBy(F.col("user_id").alias("account_id")).agg(F.min("transaction_date").alias("first_paid_date"))
    last = begun.groupBy(F.col("user_id").alias("account_id")).agg(F.max(newest).alias("newest"))
    both = first.unionByName(last, allowMissingColumns=True)
    return both.groupBy("account_id").agg(*[rule(c).alias(c) for c, rule in MILESTONE_RULES.items()])


def account_milestones(accounts: DataFrame, state: DataFrame) -> DataFrame:
    """Accounts with `first_paid_date`, `churn_date` and the days from signup to the first payment.

    An account has churned when the subscription it began last is cancelled or expired; the date is the
    end of that subscription. Accounts that never paid or have not churned have no date.
    """
    gone = F.col("newest.status").isin("cancelled", "expired")
    return accounts.select("account_id", "signup_date").join(state, "account_id", "left").select(
        "account_id",
        "first_paid_date",
        F.when(gone, F.col("newest.end_date")).alias("churn_date"),
        F.datediff("first_paid_date", "signup_date").alias("days_to_first_payment"),
    )


def time_to_first_payment(accounts: DataFrame, milestones: DataFrame) -> DataFrame:
    """Accounts, those that paid since their signup, and their days to the first payment, by industry."""
    rows = accounts.select("account_id", "industry").join(milestones, "account_id", "left")
    since = F.when(F.col("days_to_first_payment") >= 0, F.col("days_to_first_payment"))
    return rows.groupBy("industry").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count(since).alias("paid"),
        F.round(F.sum(since) / F.count(since), 4).alias("avg_days"),
        F.count("churn_date").alias("churned"),
    )
