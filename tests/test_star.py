from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import star
from ledgerline.schemas import DIM_ACCOUNT, DIM_DATE, FACT_SUBSCRIPTION_DAILY, FACT_USER_EVENTS
from plans import plan_of

AS_OF = date(2024, 6, 30)


def test_calendar_covers_six_years(spark):
    days = star.dim_date(spark)
    assert days.schema == DIM_DATE or days.columns == DIM_DATE.names
    assert days.count() == 2192
    row = days.where("full_date = date'2023-01-01'").first().asDict()
    assert (row["date_key"], row["day_of_week"], row["week_of_year"]) == (20230101, 7, 52)
    assert row["day_of_week_name"] == "Sunday   " and row["month_name"] == "January  "
    assert row["week_start_date"] == date(2022, 12, 26) and row["week_end_date"] == row["full_date"]
    assert row["is_weekend"] and not row["is_month_end"]
    end = days.where("full_date = date'2024-12-31'").first()
    assert end["is_year_end"] and end["is_quarter_end"] and end["day_of_year"] == 366
    assert days.where("is_year_end").count() == 6
    assert days.where("is_quarter_end").count() == 24


def test_plan_tiers(spark):
    rows = star.dim_plan(spark).orderBy("plan_key").collect()
    assert [(r["plan_key"], r["plan_id"], float(r["monthly_price"])) for r in rows] == [
        (1, "free", 0.0), (2, "basic", 29.0), (3, "pro", 99.0), (4, "enterprise", 299.0),
    ]
    assert rows[0]["annual_price"] is None and rows[3]["max_users"] is None


def profiles(spark, *users):
    return spark.createDataFrame(
        [(u, None, None, None, datetime(2024, 1, 1)) for u in users],
        "user_id string, industry string, company_size string, country string, created_at timestamp_ntz",
    )


def test_accounts_get_defaults_and_keys_go_on(spark):
    first = star.dim_account(profiles(spark, "bbbbbbbbbb", "a", None))
    rows = first.orderBy("account_key").collect()
    assert first.columns == DIM_ACCOUNT.names
    assert [(r["account_key"], r["account_id"]) for r in rows] == [(1, "a"), (2, "bbbbbbbbbb")]
    assert rows[1]["company_name"] == "Company bbbbbbbb"
    assert (rows[0]["industry"], rows[0]["company_size"], rows[0]["country"]) == (
        "Technology", "11-50", "Unknown",
    )
    more = star.dim_account(profiles(spark, "aa", "a"), existing=first)
    assert [(r["account_key"], r["account_id"]) for r in more.collect()] == [(3, "aa")]


def test_events_outside_the_calendar_are_left_out(spark):
    events = spark.createDataFrame(
        [("e1", "u", "a", datetime(2022, 12, 31, 23)), ("e2", "u", "a", datetime(2023, 1, 1)), ("e3", "x", "a", datetime(2024, 2, 29, 5))],
        "event_id string, user_id string, event_type string, event_ts timestamp_ntz",
    ).withColumn("country", F.lit("stale"))
    people = profiles(spark, "u").withColumn("country", F.lit("C"))
    facts = star.fact_user_events(events, people, star.dim_date(spark))
    assert facts.columns == FACT_USER_EVENTS.names
    got = {r["event_id"]: (r["date_key"], r["country"]) for r in facts.collect()}
    assert got == {"e2": (20230101, "C"), "e3": (20240229, None)}
    held = facts.where("event_id = 'e2'")
    more = star.fact_user_events(events, people, star.dim_date(spark), existing=held)
    assert [r["event_id"] for r in more.collect()] == ["e3"]


def subscriptions(spark, rows):
    return spark.createDataFrame(
        rows,
        "subscription_id string, user_id string, plan_name string, status string, "
        "start_date timestamp_ntz, end_date timestamp_ntz",
    )


def daily(spark, subs, users, as_of=AS_OF):
    accounts = star.dim_account(profiles(spark, *users))
    return star.fact_subscription_daily(subs, accounts, star.dim_plan(spark), star.dim_date(spark), as_of)


def at(text):
    return text and datetime.fromisoformat(text)


def test_snapshot_rules(spark):
    subs = subscriptions(
        spark,
        [
            ("s1", "a", "Pro", "cancelled", at("2024-06-29T15:00:00"), None),
            ("s2", "b", "Legacy", "trial", at("2024-01-01"), at("2024-05-31T08:00:00")),
            ("s3", "nobody", "Pro", "active", at("2024-01-01"), None),
            ("s4", "c", "Pro", "active", at("2024-07-01"), None),
            ("s5", "c", "Pro", "active", at("2024-06-20"), at("2024-06-10")),
            ("s6", "d", "Pro", "active", None, None),
            ("s7", None, "Pro", "active", at("2024-01-01"), None),
        ],
    )
    facts = daily(spark, subs, ["a", "b", "c", "d"])
    assert facts.columns == FACT_SUBSCRIPTION_DAILY.names
    rows = sorted(facts.collect(), key=lambda r: r["date_key"])
    assert [r["date_key"] for r in rows] == [20240531, 20240629, 20240630]
    legacy, first, second = rows
    assert (legacy["plan_key"], legacy["mrr"], legacy["subscription_status"]) == (1, 0, "trial")
    assert (first["plan_key"], float(first["mrr"]), float(first["arr"])) == (3, 99.0, 1188.0)
    assert first["is_new_subscription"] and not second["is_new_subscription"]
    assert first["is_churned"] and second["is_churned"]


def test_latest_start_wins_and_ties_go_to_the_higher_id(spark):
    subs = subscriptions(
        spark,
        [
            ("s1", "a", "Basic", "active", at("2024-01-01"), None),
            ("s2", "a", "Pro", "active", at("2024-06-15"), at("2024-06-20")),
            ("s3", "a", "Enterprise", "active", at("2024-06-15"), at("2024-06-18")),
        ],
    )
    price = {r["date_key"]: float(r["mrr"]) for r in daily(spark, subs, ["a"]).collect()}
    assert len(price) == 31
    assert price[20240614] == 29 and price[20240615] == 299 and price[20240618] == 299
    assert price[20240619] == 99 and price[20240621] == 29


def _brute_force(rows, users):
    want = {}
    for offset in range(31):
        day = AS_OF - timedelta(days=offset)
        for user in users:
            open_then = [
                r for r in rows
                if r[1] == user and r[4].date() <= day and (r[5] is None or day <= r[5].date())
            ]
            if open_then:
                best = max(open_then, key=lambda r: (r[4], r[0]))
                want[(day.year * 10000 + day.month * 100 + day.day, user)] = (best[3], best[2])
    return want


def test_snapshot_equals_brute_force_with_one_user_holding_most(spark):
    rng = random.Random(11)
    users = [f"u{i}" for i in range(12)]
    rows = []
    for n in range(900):
        user = "u0" if n % 3 else rng.choice(users)
        start = datetime(2024, 4, 1) + timedelta(hours=rng.randint(0, 24 * 100))
        end = None if rng.random() < 0.2 else start + timedelta(days=rng.randint(0, 40))
        rows.append((f"s{n:04d}", user, rng.choice(["Free", "Basic", "Pro", "Enterprise"]), rng.choice(["active", "trial"]), start, end))
    accounts = star.dim_account(profiles(spark, *users))
    facts = star.fact_subscription_daily(
        subscriptions(spark, rows), accounts, star.dim_plan(spark), star.dim_date(spark), AS_OF
    )
    named = facts.join(accounts.select("account_key", "account_id"), "account_key").join(
        star.dim_plan(spark).select("plan_key", "plan_name"), "plan_key"
    )
    got = {(r["date_key"], r["account_id"]): (r["subscription_status"], r["plan_name"]) for r in named.collect()}
    assert got == _brute_force(rows, users)


def test_snapshot_plan_has_no_nested_loop_and_few_rows_per_user(spark, sf):
    from workload.queries import Tables

    facts = Tables(spark, sf).snapshots()
    plan = plan_of(facts)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert facts.groupBy("date_key", "account_key").count().where("count > 1").isEmpty()


def test_days_are_spelled_out_after_the_shuffle_by_user(spark, sf):
    """With accounts too large to broadcast, the days of a user need no further shuffle."""
    from workload.queries import Tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, sf)
        spans = t.snapshots().groupBy().count()
        plan = plan_of(spans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    generate = plan.index("Generate explode(")
    above = plan[:generate]
    by_day = [line for line in above.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert by_day == []


@pytest.mark.parametrize("as_of, days", [(date(2024, 6, 30), 31), (date(2029, 1, 10), 21)])
def test_days_outside_the_calendar_have_no_snapshot(spark, as_of, days):
    subs = subscriptions(spark, [("s", "a", "Pro", "active", at("2023-01-01"), None)])
    assert daily(spark, subs, ["a"], as_of).count() == days
