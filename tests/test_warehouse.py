from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.plans.pipeline import EVENT_UPDATES, SUBSCRIPTION_UPDATES
from ledgerline.schemas import TABLES
from ledgerline.sinks import Warehouse
from plans import plan_of

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture
def warehouse(spark, tmp_path) -> Warehouse:
    return Warehouse(spark, str(tmp_path / "wh"))


def events(spark, *rows):
    return spark.createDataFrame(
        [(i, "u", kind, datetime.fromisoformat(at)) for i, kind, at in rows],
        "event_id string, user_id string, event_type string, event_ts timestamp_ntz",
    )


def stored(warehouse, table="user_events", *columns):
    columns = columns or ("event_id", "event_type", "event_ts", "ingested_at")
    return sorted(tuple(r) for r in warehouse.read(table).select(*columns).collect())


def transactions(spark, *rows):
    return spark.createDataFrame(
        [(i, v, datetime.fromisoformat(at)) for i, v, at in rows],
        "transaction_id string, user_id string, transaction_date timestamp_ntz",
    )


def test_tables_are_created_listed_and_emptied(spark, warehouse):
    warehouse.create_tables()
    listed = warehouse.list_tables()
    assert listed == {t: len(s.names) for t, s in sorted(TABLES.items())}
    warehouse.insert_new("user_events", events(spark, ("e", "a", "2024-01-01")), ["event_id"], FIRST)
    assert warehouse.sql("SELECT count(*) FROM user_events").first()[0] == 1
    warehouse.create_tables()
    assert warehouse.read("user_events").count() == 1
    warehouse.truncate()
    assert all(warehouse.read(t).isEmpty() for t in TABLES)
    warehouse.insert_new("user_events", events(spark, ("e", "a", "2024-01-01")), ["event_id"], FIRST)
    assert warehouse.read("user_events").count() == 1


def test_write_modes(spark, warehouse):
    df = spark.createDataFrame([("a", "x")], "user_id string, email string")
    load = warehouse._prepared("user_profiles", df, FIRST)
    assert warehouse.write("user_profiles", load, "fail") == 1
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        warehouse.write("user_profiles", load, "fail")
    warehouse.write("user_profiles", load, "append")
    assert warehouse.read("user_profiles").count() == 2
    warehouse.write("user_profiles", load, "replace")
    assert warehouse.read("user_profiles").count() == 1
    with pytest.raises(KeyError):
        warehouse.write("user_profiles", load, "merge")


def test_insert_new_leaves_held_rows_alone(spark, warehouse):
    key = ["transaction_id"]
    first = transactions(spark, ("t1", "v1", "2024-01-05"), ("t2", "v1", "2024-02-05"))
    later = transactions(spark, ("t2", "v2", "2024-03-05"), ("t3", "v2", "2024-03-05"))
    assert warehouse.insert_new("transactions", first, key, FIRST) == 2
    assert warehouse.insert_new("transactions", later, key, SECOND) == 1
    assert warehouse.insert_new("transactions", later, key, SECOND) == 0
    assert warehouse.insert_new("transactions", later.limit(0), key, SECOND) == 0
    assert stored(warehouse, "transactions", "transaction_id", "user_id", "ingested_at") == [
        ("t1", "v1", FIRST), ("t2", "v1", FIRST), ("t3", "v2", SECOND),
    ]


def test_upsert_updates_and_keeps_the_first_arrival(spark, warehouse):
    def load(df, at):
        return warehouse.upsert("user_events", df, ["event_id"], EVENT_UPDATES, at)

    assert load(events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02")), FIRST) == 2
    assert load(events(spark, ("e2", "b", "2024-01-02"), ("e3", "b", "2024-01-02")), SECOND) == 2
    assert load(events(spark).limit(0), SECOND) == 0
    want = [
        ("e1", "a", datetime(2024, 1, 1), FIRST),
        ("e2", "b", datetime(2024, 1, 2), FIRST),
        ("e3", "b", datetime(2024, 1, 2), SECOND),
    ]
    assert stored(warehouse) == want
    load(events(spark, ("e2", "b", "2024-01-02"), ("e3", "b", "2024-01-02")), SECOND)
    assert stored(warehouse) == want


def test_upsert_moves_a_row_to_another_day(spark, warehouse):
    def load(df, at):
        return warehouse.upsert("user_events", df, ["event_id"], EVENT_UPDATES, at)

    load(events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02"), ("e3", "a", "2024-01-02")), FIRST)
    load(events(spark, ("e1", "b", "2024-01-05"), ("e2", "b", "2024-01-05")), SECOND)
    assert stored(warehouse, "user_events", "event_id", "event_type", "event_date") == [
        ("e1", "b", date(2024, 1, 5)), ("e2", "b", date(2024, 1, 5)), ("e3", "a", date(2024, 1, 2)),
    ]
    days = {p.name for p in Path(warehouse.path("user_events")).glob("event_date=*")}
    assert days == {"event_date=2024-01-02", "event_date=2024-01-05"}


def test_upsert_rewrites_only_the_days_it_touches(spark, warehouse):
    def load(df, at):
        return warehouse.upsert("user_events", df, ["event_id"], EVENT_UPDATES, at)

    def files(day):
        return {p.name for p in Path(warehouse.path("user_events"), f"event_date={day}").glob("*.parquet")}

    load(events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02")), FIRST)
    untouched, touched = files("2024-01-01"), files("2024-01-02")
    load(events(spark, ("e2", "b", "2024-01-02")), SECOND)
    assert files("2024-01-01") == untouched and files("2024-01-02") != touched


def test_subscriptions_can_be_updated(spark, warehouse):
    def load(status, at):
        df = spark.createDataFrame([("s", status)], "subscription_id string, status string")
        return warehouse.upsert("subscriptions", df, ["subscription_id"], SUBSCRIPTION_UPDATES, at)

    load("trial", FIRST)
    load("active", SECOND)
    assert stored(warehouse, "subscriptions", "subscription_id", "status", "ingested_at") == [
        ("s", "active", FIRST)
    ]


def test_replace_keeps_the_declared_columns(spark, warehouse):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "user_id string, email string")
    assert warehouse.replace("user_profiles", df, FIRST) == 2
    assert warehouse.replace("user_profiles", df.where("user_id = 'b'"), SECOND) == 1
    assert warehouse.replace("user_profiles", df.limit(0), SECOND) == 0
    assert warehouse.read("user_profiles").columns == TABLES["user_profiles"].names
    assert stored(warehouse, "user_profiles", "user_id", "ingested_at") == [("b", SECOND)]


def test_old_files_without_enrichment_columns_still_read(spark, warehouse):
    old = events(spark, ("e1", "a", "2024-01-01")).withColumn("event_date", F.to_date("event_ts"))
    old.write.partitionBy("event_date").parquet(warehouse.path("user_events"))
    warehouse.upsert(
        "user_events",
        events(spark, ("e2", "a", "2024-01-01")).withColumn("country", F.lit("X")),
        ["event_id"],
        EVENT_UPDATES,
        FIRST,
    )
    assert stored(warehouse, "user_events", "event_id", "country") == [("e1", None), ("e2", "X")]


def test_sequence_numbers_are_unique_and_grow(spark, warehouse):
    def load(*ids):
        df = spark.createDataFrame(
            [(i, 20240100 + n % 3) for n, i in enumerate(ids)], "event_id string, date_key int"
        )
        return warehouse.insert_new("fact_user_events", df, ["event_id"], FIRST, sequence="event_key")

    load(*[f"a{i}" for i in range(20)])
    load(*[f"b{i}" for i in range(20)])
    rows = warehouse.read("fact_user_events").select("event_id", "event_key").collect()
    keys = {r["event_id"]: r["event_key"] for r in rows}
    assert len(set(keys.values())) == 40
    assert max(v for k, v in keys.items() if k[0] == "a") < min(v for k, v in keys.items() if k[0] == "b")


def test_staging_is_gone_after_a_load(spark, warehouse):
    for at in (FIRST, SECOND):
        warehouse.upsert("user_events", events(spark, ("e", "a", "2024-01-01")), ["event_id"], EVENT_UPDATES, at)
    assert list(Path(warehouse.root, "_staging").glob("*")) == []


def test_a_read_touches_only_the_days_asked_for(spark, warehouse):
    from plans import plan_of

    warehouse.insert_new(
        "user_events", events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02")), ["event_id"], FIRST
    )
    plan = plan_of(warehouse.read("user_events").where("event_date = date'2024-01-02'"))
    assert "PartitionFilters: [isnotnull(event_date" in plan


class Cut(Exception):
    pass


def test_a_failed_replace_leaves_the_table(spark, warehouse, monkeypatch):
    df = spark.createDataFrame([(f"s{i}", "trial") for i in range(5)], "subscription_id string, status string")
    key = ["subscription_id"]
    warehouse.upsert("subscriptions", df, key, SUBSCRIPTION_UPDATES, FIRST)
    before = stored(warehouse, "subscriptions", "subscription_id", "status")
    more = df.where("subscription_id = 's1'").withColumn("status", F.lit("active"))
    broken = more.withColumn("status", F.raise_error(F.lit("cut off")).cast("string"))
    with pytest.raises(Exception, match="cut off"):
        warehouse.write("subscriptions", warehouse._prepared("subscriptions", broken, SECOND), "replace")
    assert stored(warehouse, "subscriptions", "subscription_id", "status") == before

    def cut(*_):
        raise Cut

    monkeypatch.setattr("ledgerline.sinks.warehouse.write_text", cut)  # written, not yet complete
    with pytest.raises(Cut):
        warehouse.upsert("subscriptions", more, key, SUBSCRIPTION_UPDATES, SECOND)
    assert stored(warehouse, "subscriptions", "subscription_id", "status") == before
    monkeypatch.undo()
    warehouse.upsert("subscriptions", more, key, SUBSCRIPTION_UPDATES, SECOND)
    want = [(i, "active" if i == "s1" else s) for i, s in before]
    assert stored(warehouse, "subscriptions", "subscription_id", "status") == want
    assert stored(warehouse, "subscriptions", "ingested_at") == [(FIRST,)] * 5


def test_an_upsert_cut_off_after_its_swap_is_passed_over_by_readers(spark, warehouse, monkeypatch):
    first = events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02"), ("e3", "a", "2024-01-02"))
    moved = events(spark, ("e1", "b", "2024-01-05"), ("e2", "b", "2024-01-05"))
    warehouse.upsert("user_events", first, ["event_id"], EVENT_UPDATES, FIRST)
    before, finish = stored(warehouse), Warehouse._finish_removal
    write = Warehouse.write

    def cut(*_, **__):
        raise Cut

    monkeypatch.setattr(Warehouse, "write", cut)  # noted, not swapped
    with pytest.raises(Cut):
        warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)
    assert stored(warehouse) == before
    monkeypatch.setattr(Warehouse, "write", lambda *a, **k: (write(*a, **k), cut()))  # swapped, not removed
    with pytest.raises(Cut):
        warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)
    monkeypatch.undo()
    assert Warehouse._finish_removal is finish
    want = [("e1", "b", datetime(2024, 1, 5), FIRST), ("e2", "b", datetime(2024, 1, 5), FIRST), ("e3", "a", datetime(2024, 1, 2), FIRST)]
    assert stored(warehouse) == want
    warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)
    assert stored(warehouse) == want


def test_readers_beside_an_upsert_change_nothing(spark, warehouse, monkeypatch):
    """Before the swap, between swap and removal, and after: old rows or new rows, each once."""
    first = events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02"), ("e3", "a", "2024-01-02"), ("e4", "a", "2024-01-07"))
    moved = events(spark, ("e1", "b", "2024-01-05"), ("e2", "b", "2024-01-05"), ("e4", "b", "2024-01-01"))
    warehouse.upsert("user_events", first, ["event_id"], EVENT_UPDATES, FIRST)
    old = stored(warehouse)
    new = sorted([("e1", "b", datetime(2024, 1, 5), FIRST), ("e2", "b", datetime(2024, 1, 5), FIRST), ("e3", "a", datetime(2024, 1, 2), FIRST), ("e4", "b", datetime(2024, 1, 1), FIRST)])
    seen, reader = [], Warehouse(spark, warehouse.root)
    write, files = Warehouse.write, lambda: sorted(str(f) for f in Path(warehouse.root).rglob("*"))

    def look() -> None:
        before = files()
        seen.append(stored(reader))
        assert files() == before  # a read writes nothing

    def watched(*a, **k):
        look()
        done = write(*a, **k)
        look()
        return done

    monkeypatch.setattr(Warehouse, "write", watched)
    warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)
    monkeypatch.undo()
    assert seen == [old, new] and stored(warehouse) == new
    assert not list(Path(warehouse.root).rglob("_vacated.json"))


def test_a_swap_of_some_days_only_hides_none(spark, warehouse, monkeypatch):
    """While days are still swapped in, nothing that has no other place is passed over."""
    first = events(spark, ("e1", "a", "2024-01-01"), ("e2", "a", "2024-01-02"))
    moved = events(spark, ("e1", "b", "2024-01-05"), ("e2", "b", "2024-01-06"))
    warehouse.upsert("user_events", first, ["event_id"], EVENT_UPDATES, FIRST)
    write = Warehouse.write

    def some(self, table, df, *a, **k):
        write(self, table, df.where("event_date = date'2024-01-05'"), *a, **k)
        raise Cut

    monkeypatch.setattr(Warehouse, "write", some)
    with pytest.raises(Cut):
        warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)
    monkeypatch.undo()
    assert {r[0] for r in stored(warehouse)} == {"e1", "e2"}
    warehouse.upsert("user_events", moved, ["event_id"], EVENT_UPDATES, SECOND)  # loaded again
    assert stored(warehouse) == [("e1", "b", datetime(2024, 1, 5), FIRST), ("e2", "b", datetime(2024, 1, 6), FIRST)]


def test_null_keys_are_idempotent(spark, warehouse):
    batch = events(spark, (None, "a", "2024-01-01"), ("e", "a", "2024-01-02"))
    for at in (FIRST, SECOND, SECOND):
        warehouse.upsert("user_events", batch, ["event_id"], EVENT_UPDATES, at)
    assert [(r.event_id, r.ingested_at) for r in warehouse.read("user_events").orderBy("event_ts").collect()] == [(None, FIRST), ("e", FIRST)]
    later = events(spark, (None, "b", "2024-01-09"))
    warehouse.upsert("user_events", later, ["event_id"], EVENT_UPDATES, SECOND)
    assert warehouse.read("user_events").count() == 2


def test_upsert_of_many_dense_keys_is_not_broadcast(spark, warehouse, monkeypatch):
    """Their files are tiny, so that Spark takes them for small; in memory they are not."""
    rows = spark.range(200_000).select(
        F.lit(20240101).alias("date_key"), F.col("id").alias("account_key"), F.lit("active").alias("subscription_status")
    )
    plans, write = [], Warehouse.write

    def watched(self, table, df, *args, **kwargs):
        plans.append(plan_of(df))
        return write(self, table, df, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "write", watched)
    keys = ["date_key", "account_key"]
    warehouse.upsert("fact_subscription_daily", rows, keys, ["subscription_status"], FIRST)
    later = rows.withColumn("subscription_status", F.lit("cancelled")).where("account_key >= 50000")
    assert warehouse.upsert("fact_subscription_daily", later, keys, ["subscription_status"], SECOND) == 150_000
    assert "BroadcastExchange" not in plans[-1]
    counts = warehouse.read("fact_subscription_daily").groupBy("subscription_status").count().collect()
    assert sorted(tuple(r) for r in counts) == [("active", 50_000), ("cancelled", 150_000)]
