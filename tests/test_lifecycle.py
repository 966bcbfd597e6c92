"""Plan runs and plan changes of the daily snapshot."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.plans import lifecycle, star
from ledgerline.schemas import FACT_SUBSCRIPTION_DAILY
from plans import plan_of

COLUMNS = ["days_since_signup", "days_on_current_plan", "is_expansion", "is_contraction"]


def key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def daily(spark, rows):
    """Snapshots from (day, account, plan)."""
    return star.conform(
        spark.createDataFrame([(key(d), a, p) for d, a, p in rows], "date_key int, account_key long, plan_key int"),
        FACT_SUBSCRIPTION_DAILY,
    )


def accounts(spark, **signups):
    rows = [(int(k[1:]), v) for k, v in signups.items()]
    return spark.createDataFrame(rows, "account_key long, signup_date timestamp_ntz")


def found(df) -> dict:
    return {(r["date_key"], r["account_key"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_runs_changes_and_gaps(spark):
    d = [date(2024, 2, 27) + timedelta(days=i) for i in range(9)]
    rows = [(d[0], 1, 2), (d[1], 1, 2), (d[2], 1, 3), (d[3], 1, 3), (d[4], 1, 1), (d[6], 1, 4), (d[7], 1, 4)]
    rows += [(d[3], 2, 4), (d[4], 3, 9), (d[5], 3, 2)]
    people = accounts(spark, a1=datetime(2024, 2, 20, 23), a2=None, a3=datetime(2024, 3, 3))
    got = found(lifecycle.with_lifecycle(daily(spark, rows), people, star.dim_plan(spark)))
    assert got == {
        (20240227, 1): (7, 1, False, False),
        (20240228, 1): (8, 2, False, False),
        (20240229, 1): (9, 1, True, False),
        (20240301, 1): (10, 2, False, False),
        (20240302, 1): (11, 1, False, True),
        (20240304, 1): (13, 1, False, False),  # after a day without a snapshot: neither up nor down
        (20240305, 1): (14, 2, False, False),
        (20240301, 2): (None, 1, False, False),
        (20240302, 3): (-1, 1, False, False),
        (20240303, 3): (0, 1, False, False),  # the plan before has no tier
    }


def test_a_period_equals_its_days_one_by_one(spark, rng):
    """Each day built from the day before alone gives the rows of the whole period."""
    days = [date(2024, 2, 25) + timedelta(days=i) for i in range(10)]
    rows = []
    for account in range(1, 30):
        plan = rng.randrange(1, 5)
        for day in days:
            plan = plan if rng.random() < 0.7 else rng.randrange(1, 5)
            if rng.random() < 0.85:
                rows.append((day, account, plan))
    people = accounts(spark, **{f"a{i}": datetime(2024, 1, 1) + timedelta(days=i) for i in range(1, 30)})
    plans = star.dim_plan(spark)
    whole = found(lifecycle.with_lifecycle(daily(spark, rows), people, plans))
    assert any(v[2] for v in whole.values()) and any(v[3] for v in whole.values())

    stored, held = {}, spark.createDataFrame([], FACT_SUBSCRIPTION_DAILY)
    for day in days:
        today = daily(spark, [r for r in rows if r[0] == day])
        built = lifecycle.with_lifecycle(today, people, plans, lifecycle.stored_before(held, day))
        new = built.collect()
        held = spark.createDataFrame(new, FACT_SUBSCRIPTION_DAILY)  # nothing older than a day is kept
        stored |= {(r["date_key"], r["account_key"]): tuple(r[c] for c in COLUMNS) for r in new}
    assert stored == whole


def test_stored_rows_without_a_count_begin_at_one(spark):
    old = daily(spark, [(date(2024, 5, 1), 1, 2)])
    built = lifecycle.with_lifecycle(daily(spark, [(date(2024, 5, 2), 1, 2)]), accounts(spark, a1=None), star.dim_plan(spark), old)
    assert found(built) == {(20240502, 1): (None, 2, False, False)}


def test_the_account_window_needs_no_range_join(spark):
    built = lifecycle.with_lifecycle(daily(spark, [(date(2024, 5, 2), 1, 2)]), accounts(spark, a1=None), star.dim_plan(spark))
    plan = plan_of(built)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert built.columns == FACT_SUBSCRIPTION_DAILY.names
    assert built.where(F.col("days_on_current_plan") == 1).count() == 1
