"""As-of joins, funnels, sessions and retention on hand-made rows and against plain Python."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import asof_last, funnel, quantiles
from ledgerline.plans import behaviour, star
from plans import plan_of

T0 = datetime(2024, 1, 31, 22, 0)


def moments(rng, n):
    return [T0 + timedelta(minutes=rng.randrange(0, 600)) for _ in range(n)]


@pytest.mark.parametrize("strictly", [False, True])
@pytest.mark.parametrize("bucket", ["minute", "hour", "year"])
def test_asof_equals_looking_at_all_rows(spark, rng, strictly, bucket):
    """One user has most rows; times tie, users and times are null, rows repeat, names clash."""
    users = ["a"] * 6 + ["b", "c", None]
    left = [(rng.choice(users), t if rng.random() < 0.95 else None, i % 7) for i, t in enumerate(moments(rng, 120))]
    left += left[:5]
    right = [(rng.choice(users), t if rng.random() < 0.95 else None, i, rng.choice(["x", "y", None])) for i, t in enumerate(moments(rng, 300))]
    asked = spark.createDataFrame(left, "user string, at timestamp_ntz, _bucket int")
    held = spark.createDataFrame(right, "user string, ts timestamp_ntz, id int, value string")

    def last(user, at):
        fits = [r for r in right if user is not None and r[0] == user and at and r[1] and (r[1] < at if strictly else r[1] <= at)]
        return max(fits, key=lambda r: (r[1], r[2]))[2:] if fits else (None, None)

    got = asof_last(asked, held, "user", "at", "ts", "id", {"last_id": "id", "last_value": "value"}, strictly, bucket)
    assert got.columns == ["user", "at", "_bucket", "last_id", "last_value"]
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted([(*r, *last(*r[:2])) for r in left], key=order)


def test_asof_of_empty_sides(spark):
    empty = spark.createDataFrame([], "user string, at timestamp_ntz, id int")
    one = spark.createDataFrame([("a", T0, 1)], "user string, at timestamp_ntz, id int")
    assert asof_last(empty, one, "user", "at", "at", "id", {"found": "id"}).collect() == []
    assert asof_last(one, empty, "user", "at", "at", "id", {"found": "id"}).first()["found"] is None


def test_asof_plan_has_no_range_join_and_one_row_a_bucket_goes_on(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("user"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,id)").alias("at"), "id")
    plan = plan_of(asof_last(rows, rows, "user", "at", "at", "id", {"found": "id"}))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert "partial_max" in plan  # buckets are aggregated before they move


def test_funnel_equals_matching_step_by_step(spark, rng):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(25)]
    steps = [[(rng.choice(["a", "b", "c", "d", None]), rng.choice([*days, None])) for _ in range(n)] for n in (6, 30, 12)]
    expected = {}
    for user in "abcd":
        reached = []
        for rows in steps:
            later = [d for u, d in rows if u == user and d and (not reached or d >= reached[-1])]
            if not later:
                break
            reached.append(min(later))
        if reached:
            expected[user] = reached
    tables = [spark.createDataFrame(rows * 3, "user string, day date") for rows in steps]
    assert {r["user"]: r["days"] for r in funnel(tables, "user").collect()} == expected


def test_quantiles_are_exact(spark, rng):
    rows = [(rng.choice("xy"), rng.choice([None, *range(9)])) for _ in range(200)] + [("z", 5)]
    got = quantiles(spark.createDataFrame(rows, "g string, v int"), ["g"], "v", {"q1": 0.25, "q5": 0.5, "q9": 0.9, "all": 1.0})
    for r in got.collect():
        values = sorted(v for g, v in rows if g == r["g"] and v is not None)
        assert [r[c] for c in ("q1", "q5", "q9", "all")] == [values[math.ceil(len(values) * s) - 1] for s in (0.25, 0.5, 0.9, 1.0)]


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, user_id string, event_type string, event_ts timestamp_ntz, properties string, session_id string")


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


@pytest.mark.parametrize("merged_first", ["true", "false"])
@pytest.mark.parametrize("parts", [1, 5])
def test_sessions(spark, merged_first, parts):
    """A pause of exactly half an hour is within a session, a longer one is not; midnight is nothing special."""
    setting = "spark.sql.sessionWindow.merge.sessions.in.local.partition"
    rows = [("1", "u", "a", at(0), "{}", None), ("2", "u", "a", at(30), "{}", None), ("3", "u", "a", at(60.001), "{}", None)]
    rows += [(f"m{i}", "v", "a", at(100 + 20 * i), "{}", None) for i in range(5)]  # 23:40 to 01:00
    rows += [("4", "u", "a", at(10), "{}", "s"), ("5", "u", "a", at(500), "{}", "s"), ("6", "w", "a", at(500), "{}", "s")]
    rows += [("7", None, "a", at(0), "{}", None), ("8", None, "a", at(0), "{}", "anon")]
    spark.conf.set(setting, merged_first)
    try:
        got = {tuple(r) for r in behaviour.sessions(events(spark, rows).repartition(parts)).collect()}
    finally:
        spark.conf.set(setting, "true")
    assert got == {
        ("u", None, at(0), at(30), 2), ("u", None, at(60.001), at(60.001), 1), ("v", None, at(100), at(180), 5),
        ("u", "s", at(10), at(500), 2), ("w", "s", at(500), at(500), 1), (None, "anon", at(0), at(0), 1),
    }


def test_sessions_by_plan(spark):
    rows = [("1", "u", "a", at(0), "{}", "s"), ("2", "u", "a", at(2), "{}", "s"), ("3", "v", "a", at(0), "{}", None), ("4", "w", "a", at(0), "{}", None)]
    subscriptions = spark.createDataFrame(
        [("s1", "u", "Pro", at(-900), None), ("s2", "u", "Basic", at(-900), None), ("s3", "u", "Free", at(1), None), ("s4", "v", "Pro", at(-900), at(-1))],
        "subscription_id string, user_id string, plan_name string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    got = {r["plan"]: tuple(r)[1:] for r in behaviour.sessions_by_plan(events(spark, rows), subscriptions).collect()}
    assert got == {"basic": (1, 1, 2, 120.0, 120.0), "none": (2, 2, 2, 0.0, 0.0)}


def test_features_before_upgrades(spark):
    used = [("1", "u", "feature_used", at(0), '{"feature": "export"}', None), ("2", "u", "feature_used", at(5), '{"feature": "api"}', None)]
    used += [("3", "u", "feature_used", at(7), '{"other": 1}', None), ("4", "u", "login", at(8), '{"feature": "no"}', None), ("5", "u", "feature_used", at(8), "broken", None)]
    used += [("6", "u", "feature_used", at(10), '{"feature": "late"}', None)]
    paid = spark.createDataFrame(
        [("t1", "u", "upgrade", "completed", at(10)), ("t2", "u", "upgrade", "completed", at(5)), ("t3", "x", "upgrade", "completed", at(5)),
         ("t4", "u", "upgrade", "failed", at(9)), ("t5", "u", "payment", "completed", at(9)), ("t6", "u", "upgrade", "completed", at(60 * 24 * 40))],
        "transaction_id string, user_id string, transaction_type string, status string, transaction_date timestamp_ntz",
    )
    rows = behaviour.feature_before_upgrade(events(spark, used), paid)
    assert {r["transaction_id"]: (r["last_feature"], r["last_used_at"]) for r in rows.collect()} == {
        "t1": ("api", at(5)), "t2": ("export", at(0)), "t3": (None, None), "t6": ("late", at(10)),
    }
    got = {r["last_feature"]: tuple(r)[1:] for r in behaviour.features_before_upgrades(rows, 30).collect()}
    assert got == {"api": (1, 1, 0, 0), "export": (1, 1, 0, 0), None: (2, 2, None, None)}


def test_trial_conversion(spark):
    """Only a completed payment on or after the first trial's first day converts."""
    profiles = spark.createDataFrame([(u, "paid" if u != "d" else "organic") for u in "abcd"], "user_id string, signup_source string")
    subscriptions = spark.createDataFrame(
        [("a", "trial", at(0)), ("a", "trial", at(-9000)), ("b", "trial", at(0)), ("c", "active", at(0)), ("d", "trial", at(0)), ("e", "trial", at(0))],
        "user_id string, status string, start_date timestamp_ntz",
    )
    day = 24 * 60
    paid = spark.createDataFrame(
        [("a", "payment", "completed", at(3 * day)), ("a", "payment", "completed", at(-20 * day)), ("b", "payment", "completed", at(-60)),
         ("b", "refund", "completed", at(2 * day)), ("c", "payment", "completed", at(day)), ("d", "payment", "failed", at(day)), ("e", "payment", "completed", at(day))],
        "user_id string, transaction_type string, status string, transaction_date timestamp_ntz",
    )
    got = {r["signup_source"]: tuple(r)[1:] for r in behaviour.trial_conversion(profiles, subscriptions, paid).collect()}
    assert got == {"paid": (2, 2, 100.0, 0, 9), "organic": (1, 0, 0.0, None, None), None: (1, 1, 100.0, 1, 1)}


def test_revenue_retention(spark):
    def row(day, account, plan, mrr, status="active"):
        return (day, account, plan, Decimal(mrr), status)

    rows = [row(20240131, 1, 2, "29"), row(20240131, 2, 3, "99"), row(20240131, 3, 4, "299"), row(20240131, 4, 3, "99", "trial"), row(20240131, 6, 3, "99")]
    rows += [row(20240229, 1, 3, "99"), row(20240229, 2, 2, "29"), row(20240229, 3, 4, "299", "cancelled"), row(20240229, 5, 2, "29"), row(20240229, 6, 3, "99")]
    rows += [row(20240215, 1, 4, "299"), row(20240430, 1, 4, "299")]  # not a month end; no month end beside it
    snapshots = spark.createDataFrame(rows, "date_key int, account_key long, plan_key int, mrr decimal(10,2), subscription_status string")
    people = spark.createDataFrame([(i, "T" if i < 3 else "F", "1-10", "X") for i in range(1, 7)], "account_key long, industry string, company_size string, country string")
    found = behaviour.revenue_retention(snapshots, people, star.dim_plan(spark), star.dim_date(spark)).collect()
    got = {(r["segment"], r["value"]): tuple(float(x) if x is not None else None for x in tuple(r)[3:]) for r in found}
    assert {r["month"] for r in found} == {date(2024, 1, 1)}
    assert got["all", None] == (4, 1, 526, 70, 70, 299, 29, round(227 / 526, 6), 0.25)
    assert got["industry", "T"] == (2, 0, 128, 70, 70, 0, 0, 1.0, 0.0)
    assert got["industry", "F"] == (2, 1, 398, 0, 0, 299, 29, round(99 / 398, 6), 0.5)
    assert got["plan", None] == (0, 0, 0, 0, 0, 0, 29, None, None)  # new accounts had no plan
    assert got["plan", "basic"] == (1, 0, 29, 70, 0, 0, 0, round(99 / 29, 6), 0.0)
    for segment in ("industry", "company_size", "country", "plan"):
        parts = [v for k, v in got.items() if k[0] == segment]
        assert [sum(p[i] for p in parts) for i in range(7)] == list(got["all", None][:7])
