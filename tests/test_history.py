"""Merges by aggregates, versions of rows, and what held at a time."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import as_of, merged_by, with_versions
from ledgerline.plans import accounts
from plans import plan_of

T0 = datetime(2024, 1, 1)
DDL = "id string, a string, b int"


def at(days: float) -> datetime:
    return T0 + timedelta(days=days)


def moment(days: float):
    return F.lit(str(at(days))).cast("timestamp_ntz")


def versions(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[-2]))


def test_versions_of_a_few_rows(spark):
    def batch(*rows):
        return spark.createDataFrame(rows, DDL)

    history = with_versions(None, batch(("x", "1", 1), ("y", None, None), ("z", "", 0), (None, "no", 0)), "id", ["a", "b"], moment(0))
    second = batch(("x", "2", 1), ("y", "", None), ("w", "new", 9))  # z is missing: stays open
    history = with_versions(history, second, "id", ["a", "b"], moment(1))
    want = [
        ("w", "new", 9, at(1), None), ("x", "1", 1, at(0), at(1)), ("x", "2", 1, at(1), None),
        ("y", None, None, at(0), at(1)), ("y", "", None, at(1), None), ("z", "", 0, at(0), None),
    ]
    assert versions(history) == want
    assert versions(with_versions(history, second, "id", ["a", "b"], moment(1))) == want  # loaded again
    late = batch(("x", "old", 7), ("w", "old", 7))
    assert versions(with_versions(history, late, "id", ["a", "b"], moment(0.5))) == want  # came too late
    corrected = versions(with_versions(history, batch(("x", "2b", 1)), "id", ["a", "b"], moment(1)))
    assert corrected == [("x", "2b", 1, at(1), None) if r[:2] == ("x", "2") else r for r in want]
    back = versions(with_versions(history, batch(("x", "1", 1)), "id", ["a", "b"], moment(2)))
    assert [r for r in back if r[0] == "x"] == [want[1], ("x", "2", 1, at(1), at(2)), ("x", "1", 1, at(2), None)]
    assert versions(with_versions(history, batch(), "id", ["a", "b"], moment(3))) == want


def test_versions_equal_states_one_after_the_other(spark, rng):
    """What held at each time is what was last loaded by then."""
    history, states, held = None, {}, {}
    for day in range(6):
        rows = {f"k{i}": (rng.choice("ab"), rng.choice([None, 1])) for i in range(12) if rng.random() < 0.7}
        held = {**held, **rows}
        states[day] = dict(held)
        history = with_versions(history, spark.createDataFrame([(k, *v) for k, v in rows.items()], DDL), "id", ["a", "b"], moment(day))
    history = spark.createDataFrame(history.collect(), history.schema)
    open_ = history.where("valid_to IS NULL")
    assert open_.count() == open_.select("id").distinct().count() == len(held)
    asked = [(f"k{i}", at(day + rng.choice([0, 0.5]))) for i in range(13) for day in range(-1, 7)] + [(None, at(1)), ("k1", None)]
    found = as_of(spark.createDataFrame(asked, "id string, at timestamp_ntz"), history, "id", "at", {"was": "a", "b": "b"})
    assert len(found.collect()) == len(asked)
    for r in found.collect():
        day = (r["at"] - T0).days if r["at"] else -1
        want = states.get(min(day, 5), {}).get(r["id"], (None, None)) if day >= 0 else (None, None)
        assert (r["was"], r["b"]) == want, r
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_closed_version_without_a_next_one_holds_until_its_end(spark):
    history = spark.createDataFrame([("x", "1", at(0), at(2))], "id string, a string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    asked = spark.createDataFrame([("x", at(d)) for d in (-1, 0, 1.9, 2, 3)], "id string, at timestamp_ntz")
    found = as_of(asked, history, "id", "at", {"a": "a"}).orderBy("at").collect()
    assert [r["a"] for r in found] == [None, "1", "1", None, None]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 0), (2, 0, 2, 1)])
def test_milestones_do_not_depend_on_the_order_of_batches(spark, order):
    paid = [("u", "payment", "completed", at(9), 0), ("u", "payment", "completed", at(5), 1), ("u", "payment", "failed", at(1), 2),
            ("u", "refund", "completed", at(2), 0), ("v", "payment", "completed", at(3), 2), (None, "payment", "completed", at(0), 0)]
    begun = [("s1", "u", at(0), at(1), "active", None, 0), ("s1", "u", at(0), at(8), "cancelled", at(8), 2), ("s0", "u", at(-5), at(9), "active", None, 1),
             ("s2", "v", at(0), at(0), "expired", at(3), 0), ("s3", "v", at(4), at(4), "trial", None, 1), ("s4", "w", at(0), at(0), "expired", at(7), 2)]
    transactions = spark.createDataFrame(paid, "user_id string, transaction_type string, status string, transaction_date timestamp_ntz, n int")
    subscriptions = spark.createDataFrame(begun, "subscription_id string, user_id string, start_date timestamp_ntz, updated_at timestamp_ntz, status string, end_date timestamp_ntz, n int")
    state = None
    for n in order:
        batch = accounts.milestone_state(subscriptions.where(F.col("n") == n), transactions.where(F.col("n") == n))
        state = batch if state is None else merged_by(state, batch, ["account_id"], accounts.MILESTONE_RULES)
    people = spark.createDataFrame([(u, at(1), "T") for u in "uvwx"], "account_id string, signup_date timestamp_ntz, industry string")
    found = accounts.account_milestones(people, state)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {
        "u": (at(5), at(8), 4), "v": (at(3), None, 2), "w": (None, at(7), None), "x": (None, None, None),
    }
    assert [tuple(r) for r in accounts.time_to_first_payment(people, found).collect()] == [("T", 4, 2, 3.0, 2)]
