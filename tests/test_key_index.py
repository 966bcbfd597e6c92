"""Loads that find stored keys through the index."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame

from ledgerline.plans.pipeline import EVENT_UPDATES
from ledgerline.sinks import Warehouse, key_index
from plans import plan_of

RUN = datetime(2024, 3, 1)
DAY = datetime(2024, 1, 1)
KEY = ["event_id"]


def events(spark, rows) -> DataFrame:
    """(id, kind, day) as events."""
    return spark.createDataFrame(
        [(i, "u", kind, DAY + timedelta(days=d)) for i, kind, d in rows],
        "event_id string, user_id string, event_type string, event_ts timestamp_ntz",
    )


def stored(warehouse) -> list:
    rows = warehouse.read("user_events").select("event_id", "event_type", "event_date", "ingested_at").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.fixture
def pair(spark, tmp_path) -> tuple[Warehouse, Warehouse]:
    """A warehouse that always uses the index and one that never does."""
    return Warehouse(spark, str(tmp_path / "with"), 0), Warehouse(spark, str(tmp_path / "without"), 1 << 60)


def test_loads_give_the_same_rows_with_and_without(spark, pair, rng, monkeypatch):
    monkeypatch.setattr(key_index, "ENTRIES", 7)
    monkeypatch.setattr(key_index, "MERGE_AT", 3)
    for load in range(6):
        ids = rng.sample([None, *(f"e{i}" for i in range(30))], 12)
        batch = [(i, f"k{load}", rng.randint(0, 5)) for i in ids]
        for warehouse in pair:
            at = RUN + timedelta(days=load)
            if load % 3 == 2:
                warehouse.insert_new("user_events", events(spark, batch), KEY, at)
            else:
                warehouse.upsert("user_events", events(spark, batch), KEY, EVENT_UPDATES, at)
        assert stored(pair[0]) == stored(pair[1])
    rows = stored(pair[0])
    assert len({r[0] for r in rows}) == len(rows)


def test_only_the_days_of_the_batchs_keys_are_scanned(spark, pair, monkeypatch):
    warehouse = pair[0]
    warehouse.upsert("user_events", events(spark, [(f"e{d}", "a", d) for d in range(20)]), KEY, EVENT_UPDATES, RUN)
    seen = []
    monkeypatch.setattr(Warehouse, "_in_partitions", staticmethod(_spy(Warehouse._in_partitions, seen)))
    warehouse.upsert("user_events", events(spark, [("e3", "b", 4), ("new", "b", 4)]), KEY, EVENT_UPDATES, RUN)
    assert seen[0][0] == {(DAY + timedelta(days=3)).date()}
    assert "PartitionFilters: [event_date" in seen[0][1].replace("isnotnull(event_date#", "event_date#")
    assert warehouse.insert_new("user_events", events(spark, [("e9", "c", 1), ("n2", "c", 1)]), KEY, RUN) == 1
    assert seen[1][0] == {(DAY + timedelta(days=9)).date()}


def _spy(inner, seen):
    def run(table, df, values):
        out = inner(table, df, values)
        seen.append((values, plan_of(out)))
        return out

    return run


def test_entries_of_a_load_that_died_hide_nothing(spark, pair, monkeypatch):
    warehouse = pair[0]
    warehouse.upsert("user_events", events(spark, [("a", "x", 0), ("b", "x", 1)]), KEY, EVENT_UPDATES, RUN)
    warehouse.upsert("user_events", events(spark, [("b", "x", 1)]), KEY, EVENT_UPDATES, RUN)
    write = Warehouse.write
    monkeypatch.setattr(Warehouse, "write", _fail)
    with pytest.raises(OSError):
        warehouse.insert_new("user_events", events(spark, [("c", "x", 2)]), KEY, RUN)
    with pytest.raises(OSError):
        warehouse.upsert("user_events", events(spark, [("a", "y", 3)]), KEY, EVENT_UPDATES, RUN)
    monkeypatch.setattr(Warehouse, "write", write)
    assert warehouse.insert_new("user_events", events(spark, [("c", "x", 2)]), KEY, RUN) == 1
    warehouse.upsert("user_events", events(spark, [("a", "y", 4)]), KEY, EVENT_UPDATES, RUN)
    assert [r[:2] for r in stored(warehouse)] == [("a", "y"), ("b", "x"), ("c", "x")]


def _fail(*_args, **_kwargs):
    raise OSError("lost")


def test_rows_written_past_the_index_are_found(spark, pair):
    warehouse = pair[0]
    warehouse.upsert("user_events", events(spark, [("a", "x", 0)]), KEY, EVENT_UPDATES, RUN)
    warehouse.upsert("user_events", events(spark, [("a", "x", 0)]), KEY, EVENT_UPDATES, RUN)
    warehouse.write("user_events", warehouse._prepared("user_events", events(spark, [("b", "x", 1)]), RUN))
    assert warehouse.insert_new("user_events", events(spark, [("b", "y", 2)]), KEY, RUN) == 0
    warehouse.truncate(["user_events"])
    assert warehouse.insert_new("user_events", events(spark, [("a", "z", 2)]), KEY, RUN) == 1
    assert warehouse.insert_new("user_events", events(spark, [("a", "z", 3), ("b", "z", 3)]), KEY, RUN) == 1


@pytest.mark.parametrize("small", [True, False])
def test_a_load_looks_its_keys_up_once(spark, pair, monkeypatch, small):
    """The entries meet the batch in one job, whose result both the days and the new entries come from."""
    warehouse = pair[0]
    warehouse.upsert("user_events", events(spark, [(f"e{d}", "a", d) for d in range(5)]), KEY, EVENT_UPDATES, RUN)
    warehouse.upsert("user_events", events(spark, [("e0", "b", 1)]), KEY, EVENT_UPDATES, RUN)
    if not small:
        monkeypatch.setattr(key_index, "BROADCAST_ROWS", -1)
    index, reads = warehouse._index("user_events", KEY), []
    monkeypatch.setattr(index, "_read", lambda path, like, own=index._read: (reads.append(path), own(path, like))[1])
    batch = events(spark, [("e0", "c", 1), ("e1", "c", 3), ("new", "c", 2), (None, "c", 2)])
    batch = batch.selectExpr("event_id", "CASE WHEN event_id = 'e1' THEN NULL ELSE CAST(event_ts AS DATE) END AS event_date")
    with index.find(batch, 4) as found:
        days = {d.day for d in index.partitions(found)}
        assert days == {1, 2}
        index.add(found)
        assert "Join" not in plan_of(found)
    assert len(reads) == 1
    with index.find(batch, 4) as found:
        rows = {r.event_id: {k.v and k.v.day for k in r._known} for r in found.collect()}
    assert rows == {"e0": {1, 2}, "e1": {2, None}, "new": {3}, None: {3}}
    assert not [n for n in key_index.children(spark, index.folder) if n.startswith("found-")]
