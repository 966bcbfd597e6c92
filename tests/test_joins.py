from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import (
    enrich_user_events,
    rows_not_in,
    skew_safe_lookup,
    upserted,
    with_dense_keys,
)
from ledgerline.operators.lookup import HOT_KEYS, hot_keys
from ledgerline.operators import merge
from plans import plan_of


@pytest.fixture
def no_broadcast(spark):
    """Makes Spark take every table for too large to broadcast by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark, rows=30000):
    """A third of the rows under one key, some without a key, some under keys nobody knows."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, F.lit(None))
        .when(F.col("id") % 11 == 0, "spread-1")
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
    )
    return spark.range(rows).select(F.col("id").cast("string").alias("event_id"), key.alias("user_id"))


def lookup_table(spark):
    ids = spark.range(4000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    named = ids.union(spark.createDataFrame([("hot",), ("spread-7",)], "user_id string"))
    return named.withColumn("country", F.concat(F.lit("c-"), F.col("user_id")))


def test_hot_keys_are_found_and_bounded(spark):
    found = hot_keys(skewed(spark), "user_id")
    assert "hot" in found and "spread-1" in found
    assert len(found) <= HOT_KEYS and None not in found
    assert hot_keys(skewed(spark).limit(0), "user_id") == []


def test_lookup_gives_the_rows_of_a_plain_join(spark, no_broadcast):
    df, table = skewed(spark), lookup_table(spark)
    got = skew_safe_lookup(df, table, "user_id", ["country"], "event_id")
    want = df.join(table, "user_id", "left").select(*df.columns, "country")
    assert got.columns == want.columns
    assert got.count() == df.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_rows_do_not_meet_in_one_task(spark, no_broadcast):
    joined = skew_safe_lookup(skewed(spark), lookup_table(spark), "user_id", ["country"], "event_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_small_lookup_is_a_plain_broadcast_join(spark, sf):
    nation = spark.read.parquet(f"{sf}/nation.parquet").select(
        F.col("n_name").alias("user_id"), F.col("n_name").alias("country")
    )
    plan = plan_of(skew_safe_lookup(skewed(spark), nation, "user_id", ["country"], "event_id"))
    assert plan.count("BroadcastHashJoin") == 1 and "approx_top_k" not in plan


def test_enrichment_without_profiles_or_columns(spark):
    df = spark.createDataFrame([("e", "u")], "event_id string, user_id string")
    for profiles in (None, spark.createDataFrame([("u",)], "user_id string")):
        row = enrich_user_events(df, profiles).first()
        assert (row["country"], row["signup_source"], row["company_size"]) == (None, None, None)


def test_enrichment_takes_the_last_profile_and_replaces_old_columns(spark):
    df = spark.createDataFrame(
        [("e1", "u", "old"), ("e2", None, "old"), ("e3", "x", "old")],
        "event_id string, user_id string, country string",
    )
    profiles = spark.createDataFrame(
        [("u", "first", 0), ("u", "last", 1), (None, "nobody", 2)],
        "user_id string, country string, n int",
    )
    rows = {r["event_id"]: r for r in enrich_user_events(df, profiles, ["n"]).collect()}
    assert {k: r["country"] for k, r in rows.items()} == {"e1": "last", "e2": None, "e3": None}
    assert rows["e1"]["signup_source"] is None


@pytest.mark.parametrize("ranges", [1, 3, 8, 64, 1000])
def test_dense_keys_follow_the_order_of_the_natural_key(spark, ranges):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    rows = with_dense_keys(df, "k", "n", start=5, ranges=ranges).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(5, 1005))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_dense_keys_of_few_or_no_rows(spark):
    few = spark.createDataFrame([("b",), ("a",)], "k string")
    assert [tuple(r) for r in with_dense_keys(few, "k", "n").orderBy("n").collect()] == [(1, "a"), (2, "b")]
    assert with_dense_keys(few.limit(0), "k", "n").count() == 0


def test_dense_keys_never_sort_all_rows_in_one_task(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    plan = plan_of(with_dense_keys(df, "k", "n"))
    single = plan.index("Exchange SinglePartition")
    assert "HashAggregate" in plan[single : single + 200]


def test_rows_not_in_treats_null_as_a_key(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 3), (None, 4), ("b", 5)], "k string, v int")
    assert [tuple(r) for r in rows_not_in(target, batch, ["k"]).collect()] == [("b", 5)]
    assert rows_not_in(target.limit(0), batch, ["k"]).count() == 3


def test_upsert_keeps_columns_it_does_not_update(spark):
    columns = "k string, v int, kept string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), ("c", None, None)], columns)
    batch = spark.createDataFrame([("b", None, "new"), ("c", 7, "new"), ("d", 9, "new")], columns)
    got = sorted(tuple(r) for r in upserted(target, batch, ["k"], ["v"]).collect())
    assert got == [("a", 1, "old"), ("b", None, "old"), ("c", 7, None), ("d", 9, "new")]


def test_upsert_heals_a_key_held_twice(spark):
    columns = "k string, v int, kept string"
    target = spark.createDataFrame([("a", 1, "old"), ("a", 2, "old")], columns)
    batch = spark.createDataFrame([("a", 3, "new")], columns)
    assert [tuple(r) for r in upserted(target, batch, ["k"], ["v"]).collect()] == [("a", 3, "old")]


def test_upsert_gives_the_same_rows_whatever_the_join(spark, tmp_path):
    """Stored as files, with null and repeated keys: broadcast or not, and once more on top."""
    columns = "k string, v int, ingested_at timestamp_ntz, kept string"
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    held = [
        ("x", 1, early, "old"), ("x", 1, early, "old"), (None, 5, late, "b"), (None, 6, early, "c"),
        ("z", 2, late, "d"), ("z", 3, early, "e"), ("w", None, None, None),
    ]
    spark.createDataFrame(held, columns).repartition(3).write.parquet(str(tmp_path / "held"))
    new = [("z", 9, late, "new"), (None, 7, late, "new"), ("w", 8, late, "new"), ("n", 4, late, "new")]
    spark.createDataFrame(new, columns).write.parquet(str(tmp_path / "new"))
    want = [
        ("None", 7, early, "c"), ("n", 4, late, "new"), ("w", 8, None, None), ("x", 1, early, "old"),
        ("x", 1, early, "old"), ("z", 9, early, "e"),
    ]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            target, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("held", "new"))
            merged = upserted(target, batch, ["k"], ["v"])
            got = [(str(k), *rest) for k, *rest in map(tuple, merged.collect())]
            assert sorted(got, key=str) == sorted(want, key=str)
            again = upserted(merged, batch, ["k"], ["v"])
            assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
            plans.append("Broadcast" in plan_of(merged))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans == [False, True]


def test_rows_not_in_gives_the_same_rows_on_either_path(spark, no_broadcast):
    target = spark.createDataFrame([("a", 1), (None, 2), ("a", 9)], "k string, v int")
    batch = spark.createDataFrame([("a", 3), (None, 4), ("b", 5), ("b", 6)], "k string, v int")
    got = sorted(tuple(r) for r in rows_not_in(target, batch, ["k"]).collect())
    assert got == [("b", 5), ("b", 6)]
    assert plan_of(rows_not_in(target, batch, ["k"])).count("SortMergeJoin") == 1


def test_many_rows_upserted_at_once_give_the_rows_of_few(spark, monkeypatch):
    columns = "a string, b int, v int, w string, ingested_at int"
    target = spark.createDataFrame(
        [("x", 1, 1, "late", 2), ("x", 1, 2, "early", 1), ("x", 1, 3, None, 1), (None, 1, 4, "n", 1),
         (None, 1, 5, "n2", None), ("y", None, 6, "kept", 1), ("y", None, 6, "kept", 1), ("z", 2, 7, None, None)],
        columns,
    )
    batch = spark.createDataFrame(
        [("x", 1, 11, "new", 9), (None, 1, 12, "new", 9), ("z", 2, 13, "new", 9), ("z", None, 14, "new", 9)], columns
    )
    few = sorted(map(str, upserted(target, batch, ["a", "b"], ["v"], 4).collect()))
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 3)
    many = upserted(target, batch, ["a", "b"], ["v"], 4)
    assert plan_of(many).count("Exchange hashpartitioning") == 1
    assert sorted(map(str, many.collect())) == few and len(few) == 6
