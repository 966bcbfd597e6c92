"""Use by day, and what longer periods make of it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.plans import star, usage
from ledgerline.schemas import FACT_SUBSCRIPTION_DAILY
from plans import plan_of

DDL = "event_id string, user_id string, event_ts timestamp_ntz, country string"


def test_days_and_periods(spark, rng):
    """Merged days count each user once; the estimate stays within its error, and no event is read for it."""
    start = datetime(2024, 1, 1)
    rows = [(str(i), f"u{int(rng.random() ** 3 * 9000)}" if i % 20 else None, start + timedelta(minutes=rng.randrange(60 * 24 * 14)), rng.choice(["DE", None])) for i in range(40_000)]
    events = spark.createDataFrame(rows, DDL)
    days = usage.usage_by_day(events, ["country"])
    for r in days.collect():
        own = [x for x in rows if x[2].date() == r["usage_date"] and x[3] == r["country"]]
        assert (r["total_events"], r["active_users"]) == (len(own), len({x[1] for x in own} - {None}))
    week = F.date_trunc("week", F.col("usage_date"))
    for r in usage.usage_of_periods(days, week, ["country"]).collect():
        own = [x for x in rows if r["period"] <= x[2] < r["period"] + timedelta(days=7) and x[3] == r["country"]]
        exact = len({x[1] for x in own} - {None})
        assert r["total_events"] == len(own) and abs(r["active_users_estimate"] - exact) <= 0.05 * exact
    exact = usage.active_users(events, F.date_trunc("week", "event_ts")).orderBy("period").collect()
    assert [r["active_users"] for r in exact] == [len({x[1] for x in rows if x[2].isocalendar()[1] == w} - {None}) for w in (1, 2)]


def test_days_in_batches_merge_to_the_same_periods(spark, rng):
    """A day stored in two batches gives the users of both, counted once."""
    rows = [(str(i), f"u{rng.randrange(50)}", datetime(2024, 1, 1, 5), "DE") for i in range(300)]
    first, second = spark.createDataFrame(rows[:200], DDL), spark.createDataFrame(rows[100:], DDL)
    both = usage.usage_by_day(first).unionByName(usage.usage_by_day(second))
    merged = usage.usage_of_periods(both, F.col("usage_date")).first()
    assert merged["active_users_estimate"] == len({r[1] for r in rows})


def test_snapshots_get_the_use_of_their_day(spark):
    daily = star.conform(spark.createDataFrame([(20240101, 1), (20240102, 1), (20240101, 2)], "date_key int, account_key long"), FACT_SUBSCRIPTION_DAILY)
    accounts = spark.createDataFrame([(1, "a"), (2, "b")], "account_key long, account_id string")
    events = spark.createDataFrame(
        [("1", "a", datetime(2024, 1, 1, 0), "x"), ("2", "a", datetime(2024, 1, 1, 23), "x"), ("3", None, datetime(2024, 1, 1), "x"), ("4", "c", datetime(2024, 1, 1), "x"), ("5", "b", datetime(2024, 1, 2), "x")], DDL
    )
    found = usage.with_usage(daily, accounts, events)
    assert found.columns == FACT_SUBSCRIPTION_DAILY.names
    got = {(r["date_key"], r["account_key"]): (r["active_users"], r["total_events"]) for r in found.collect()}
    assert got == {(20240101, 1): (1, 2), (20240102, 1): (0, 0), (20240101, 2): (0, 0)}
    assert "NestedLoop" not in plan_of(found)
