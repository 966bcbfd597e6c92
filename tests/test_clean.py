from __future__ import annotations

import json
import random
import string
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions import normalised_properties, parse_money
from ledgerline.functions.properties import is_json
from ledgerline.operators import (
    CleaningCounts,
    clean_subscriptions,
    clean_transactions,
    clean_user_events,
    clean_user_profiles,
    keep_first,
    keep_last,
    require_columns,
)
from plans import plan_of

RUN = datetime(2024, 5, 1, 12, 0, 0)


def events(spark, rows, schema="event_id string, user_id string, event_type string, event_ts string, n int"):
    return spark.createDataFrame(rows, schema)


def test_event_types_become_lower_case_and_properties_are_added(spark):
    df = events(
        spark,
        [
            ("e1", "u1", "page_view", "2024-01-01T10:00:00", 0),
            ("e2", "u2", "CLICK", "2024-01-01T11:00:00", 1),
            ("e3", "u3", "feature_used", "2024-01-01T12:00:00", 2),
        ],
    )
    rows = clean_user_events(df, ["n"]).collect()
    assert len(rows) == 3
    assert all(r["event_type"].islower() and r["properties"] == "{}" for r in rows)
    assert {r["event_ts"] for r in rows} == {datetime(2024, 1, 1, h) for h in (10, 11, 12)}


def test_event_whose_first_copy_has_no_time_disappears(spark):
    df = events(
        spark,
        [("e1", "u", "a", None, 0), ("e1", "u", "a", "2024-01-01", 1), ("e2", "u", "a", "2024-01-02", 2)],
    )
    assert [r["event_id"] for r in clean_user_events(df, ["n"]).collect()] == ["e2"]


def test_unreadable_event_time_fails_the_job(spark):
    df = events(spark, [("e1", "u", "a", "yesterday", 0)])
    with pytest.raises(PySparkException, match="unreadable timestamp in event_ts: yesterday"):
        clean_user_events(df, ["n"]).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_and_tolerant_parsing_do_not_depend_on_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            clean_user_events(events(spark, [("e", "u", "a", "x", 0)]), ["n"]).collect()
        df = spark.createDataFrame(
            [("s", "u", "pro", "active", "x", "y")],
            "subscription_id string, user_id string, plan_name string, status string, "
            "start_date string, monthly_revenue string",
        )
        row = clean_subscriptions(df, ["start_date"], RUN).first()
        assert row["start_date"] is None and row["monthly_revenue"] == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_subscriptions_without_optional_columns(spark):
    df = spark.createDataFrame(
        [("s1", "u1", "basic", "active", "2024-01-01", 29.0), ("s2", "u2", "pro", "cancelled", "2024-01-01", 99.0)],
        "subscription_id string, user_id string, plan_name string, status string, "
        "start_date string, monthly_revenue double",
    )
    rows = clean_subscriptions(df, ["start_date"], RUN).collect()
    assert len(rows) == 2 and min(r["monthly_revenue"] for r in rows) >= 0
    assert "updated_at" not in rows[0].asDict()


def test_subscription_rules(spark):
    columns = (
        "subscription_id string, user_id string, plan_name string, status string, "
        "start_date string, created_at string, updated_at string, monthly_revenue string, n int"
    )
    df = spark.createDataFrame(
        [
            ("null revenue", "u", "p", "active", "2024-01-01", "2024-01-02", None, None, 0),
            ("negative", "u", "p", "active", "2024-01-01", None, None, "-1", 1),
            ("bad status", "u", "p", "Active", "2024-01-01", None, None, "1", 2),
            ("no status", "u", "p", None, "2024-01-01", None, None, "1", 3),
            ("no dates", "u", "p", "trial", "soon", None, "later", "abc", 4),
            ("twice", "old", "p", "active", "2024-01-01", None, "2024-03-01", "1", 5),
            ("twice", "new", "p", "expired", "2024-01-01", None, "2024-03-01", "2", 6),
            ("last bad", "kept", "p", "active", "2024-01-01", None, None, "3", 7),
            ("last bad", "dropped", "p", "paused", "2024-01-01", None, None, "4", 8),
        ],
        columns,
    )
    rows = {r["subscription_id"]: r for r in clean_subscriptions(df, ["n"], RUN).collect()}
    assert set(rows) == {"null revenue", "no dates", "twice", "last bad"}
    assert rows["null revenue"]["monthly_revenue"] == 0
    assert rows["null revenue"]["updated_at"] == datetime(2024, 1, 2)
    assert rows["no dates"]["start_date"] is None
    assert rows["no dates"]["updated_at"] == RUN
    assert rows["twice"]["user_id"] == "new"
    assert rows["last bad"]["user_id"] == "kept"


def test_mixed_date_forms_are_read_one_by_one(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", "2024-01-01T10:00:00"), ("c", "2024-01-01 10:00:00.5"), ("d", "x")],
        "user_id string, created_at string",
    ).withColumn("email", F.lit("a@b"))
    rows = {r["user_id"]: r["created_at"] for r in clean_user_profiles(df, ["user_id"]).collect()}
    assert rows == {
        "a": datetime(2024, 1, 1),
        "b": datetime(2024, 1, 1, 10),
        "c": datetime(2024, 1, 1, 10, 0, 0, 500000),
    }


def test_transaction_rules(spark):
    columns = (
        "transaction_id string, user_id string, amount string, transaction_type string, "
        "status string, transaction_date string, n int"
    )
    df = spark.createDataFrame(
        [
            ("refund", "u", "-5.25", "refund", "completed", "2024-01-01", 0),
            ("no amount", "u", None, "payment", "completed", "2024-01-01", 1),
            ("bad amount", "u", "1,000", "payment", "completed", "2024-01-01", 2),
            ("no date", "u", "1", "payment", "completed", None, 3),
            ("bad type", "u", "1", "gift", "completed", "2024-01-01", 4),
            ("bad status", "u", "1", "payment", "done", "2024-01-01", 5),
            ("twice", "first", "1", "payment", "failed", "2024-01-01", 6),
            ("twice", "second", "2", "payment", "pending", "2024-01-01", 7),
        ],
        columns,
    )
    rows = {r["transaction_id"]: r for r in clean_transactions(df, ["n"]).collect()}
    assert set(rows) == {"refund", "twice"}
    assert rows["refund"]["amount"] == Decimal("-5.25")
    assert rows["twice"]["user_id"] == "first"
    assert clean_transactions(df.drop("transaction_date"), ["n"]).count() == 3


def test_profile_rules(spark):
    df = spark.createDataFrame(
        [
            ("a", "a@x", "2024-01-01", 0),
            ("a", "a@y", "2024-01-01", 1),
            ("b", "no at sign", "2024-01-01", 2),
            ("c", None, "2024-01-01", 3),
            ("d", "d@x", None, 4),
        ],
        "user_id string, email string, created_at string, n int",
    )
    assert [(r["user_id"], r["email"]) for r in clean_user_profiles(df, ["n"]).collect()] == [("a", "a@y")]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, n int")
    assert sorted(r["n"] for r in keep_first(df, ["k"], ["n"]).collect()) == [1, 3]
    assert sorted(r["n"] for r in keep_last(df, ["k"], ["n"]).collect()) == [2, 3]


def test_last_is_the_mirror_of_first_with_nulls(spark):
    df = spark.createDataFrame([("a", None, 0), ("a", 1, 1), ("a", 2, 2)], "k string, o int, n int")
    assert keep_first(df, ["k"], ["o"]).first()["n"] == 0
    assert keep_last(df, ["k"], ["o"]).first()["n"] == 2


def test_dedup_needs_an_order(spark):
    with pytest.raises(ValueError):
        keep_first(spark.range(1), ["id"], [])


def test_dedup_reduces_copies_before_the_shuffle(spark):
    plan = plan_of(keep_first(spark.range(10).selectExpr("id", "id % 3 AS k"), ["k"], ["id"]))
    below = plan[plan.index("Exchange hashpartitioning(k") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="event_ts"):
        clean_user_events(spark.createDataFrame([], "event_id string, user_id string, event_type string"), ["event_id"])
    require_columns(spark.range(1), ["id"])


def test_cleaning_twice_changes_nothing(spark, sf):
    from workload import bindings as b

    for name, clean in [
        ("user_profiles", clean_user_profiles),
        ("transactions", clean_transactions),
        ("dirty_events", clean_user_events),
    ]:
        once = clean(b.raw(spark, sf, name), b.ORDER_BY[name])
        twice = clean(once, b.ORDER_BY[name])
        assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_counts_come_with_the_result(spark):
    counts = CleaningCounts()
    df = events(
        spark,
        [("e1", "u", "a", "2024-01-01", 0), ("e1", "u", "a", "2024-01-01", 1), ("e2", "u", "a", None, 2)],
    )
    clean_user_events(df, ["n"], counts).collect()
    assert counts.counts == {"read": 3, "unique": 2, "kept": 1}


@pytest.mark.parametrize(
    "text, value",
    [
        ("5d", None), ("inf", None), ("", None), ("1,000", None), ("abc", None), (None, None),
        ("1e2", "100.00"), (" 3 ", "3.00"), ("1.005", "1.01"), ("-2", "-2.00"), ("1e12", None),
    ],
)
def test_money(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(parse_money("x")).first()[0] == (value and Decimal(value))


def _python_accepts(text: str) -> bool:
    def refuse(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=refuse)
    except (ValueError, RecursionError):
        return False
    return True


def _mutations(count: int) -> list[str]:
    rng = random.Random(7)
    seeds = ['{"a": 1}', '[1, 2]', '"x"', "null", "true", "12.5", '{"a": {"b": [1, null]}}', '{"a":1,"a":2}']
    alphabet = '{}[]",:01 ae.' + "\\"
    made = []
    for _ in range(count):
        text = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            if rng.random() < 0.5 and at < len(text):
                del text[at]
            else:
                text.insert(at, rng.choice(alphabet))
        made.append("".join(text))
    return made


def test_json_check_agrees_with_python(spark):
    cases = [
        '{"a":1} x', "1,2", "1],[2", '{"a":1,"a":2}', "123", "null", "[1]", "", "  ", '{"v":1',
        "1} x", "1] x", '"a', '"a"', '1,"a":2', '{"a":NaN}', "{'a':1}", "// c", "01", "1.", ".5",
        "-", "tru", "true", "\t{}\n", '{"a":1}}', "}{", '1}{"v":1', '1,"v":2', '1],"v":[2', "[1}",
    ] + _mutations(3000)
    rows = spark.createDataFrame([(c,) for c in cases], "p string").select("p", is_json(F.col("p")))
    wrong = [r[0] for r in rows.collect() if r[1] != _python_accepts(r[0])]
    assert wrong == []


def test_properties_of_every_type(spark):
    text = spark.createDataFrame([('{"a": 1}',), ("not json",), (None,), ("[1]",)], "properties string")
    assert [r[0] for r in text.select(normalised_properties(text)).collect()] == [
        '{"a": 1}', "{}", "{}", "[1]",
    ]
    struct = spark.createDataFrame([((1, None),), (None,)], "properties struct<a:int,b:string>")
    assert [r[0] for r in struct.select(normalised_properties(struct)).collect()] == [
        '{"a":1,"b":null}', "{}",
    ]
    number = spark.createDataFrame([(5,)], "properties int")
    assert number.select(normalised_properties(number)).first()[0] == "{}"
    variant = text.select(F.try_parse_json("properties").alias("properties")).union(
        spark.sql("select parse_json('\"{\\\\\"b\\\\\":2}\"')")
    )
    got = [r[0] for r in variant.select(normalised_properties(variant)).collect()]
    assert got == ['{"a":1}', "{}", "{}", "{}", '{"b":2}']


def test_event_times_stay_pushable(spark, sf):
    from workload import bindings as b

    df = b.raw(spark, sf, "user_events").where(F.col("event_ts") > F.lit(b.SINCE).cast("timestamp_ntz"))
    assert "GreaterThan(ts" in plan_of(df)


def test_random_strings_never_break_normalisation(spark):
    rng = random.Random(3)
    cases = ["".join(rng.choice(string.printable) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    df = spark.createDataFrame([(c,) for c in cases], "properties string")
    for before, after in df.select("properties", normalised_properties(df)).collect():
        assert after == (before if _python_accepts(before) else "{}")
