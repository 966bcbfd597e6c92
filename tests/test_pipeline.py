from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from ledgerline.plans import metrics
from ledgerline.plans.pipeline import build_star, check_quality, run_etl, run_pipeline
from ledgerline.plans.quality_suite import QualityError
from ledgerline.schemas import TABLES
from ledgerline.sinks import Warehouse
from ledgerline.streaming import load_new_event_files

FIRST, SECOND = datetime(2024, 6, 1), datetime(2024, 6, 2)
AS_OF = date(2024, 6, 1)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    sources = {
        "user_profiles": [
            {"user_id": "u1", "email": "a@x", "created_at": "2024-01-01", "country": "DE", "signup_source": "paid"},
            {"user_id": "u2", "email": "b@x", "created_at": "2024-01-01", "country": "FR"},
        ],
        "subscriptions": [
            {"subscription_id": "s1", "user_id": "u1", "plan_name": "Pro", "status": "active", "start_date": "2024-05-20", "end_date": None, "monthly_revenue": 99.0, "created_at": "2024-05-20", "updated_at": None},
            {"subscription_id": "s2", "user_id": "u2", "plan_name": "basic", "status": "paused", "start_date": "2024-05-20", "monthly_revenue": 29.0},
        ],
        "transactions": [
            {"transaction_id": "t1", "user_id": "u1", "subscription_id": "s1", "amount": 99.0, "transaction_type": "payment", "status": "completed", "transaction_date": "2024-05-20"},
        ],
        "user_events": [
            {"event_id": "e1", "user_id": "u1", "event_type": "LOGIN", "timestamp": "2024-05-21T10:00:00", "properties": {"a": 1}},
            {"event_id": "e2", "user_id": "u2", "event_type": "login", "timestamp": "2024-05-22T10:00:00", "properties": {}, "session_id": "x"},
        ],
    }
    for name, rows in sources.items():
        (folder / f"{name}.json").write_text(json.dumps(rows))
    return folder


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def contents(warehouse):
    return {t: sorted(map(str, warehouse.read(t).collect())) for t in TABLES}


def test_load_and_star_and_gate(spark, raw, warehouse):
    loaded, quality = run_pipeline(spark, str(raw), warehouse, FIRST)
    assert loaded == {"user_profiles": 2, "subscriptions": 1, "transactions": 1, "user_events": 2}
    assert quality.success and quality.total_checks == 17
    events = {r["event_id"]: r for r in warehouse.read("user_events").collect()}
    assert (events["e1"]["event_type"], events["e1"]["country"], events["e1"]["signup_source"]) == ("login", "DE", "paid")
    assert build_star(spark, warehouse, AS_OF, FIRST) == {
        "dim_account": 2, "dim_plan": 4, "dim_date": 2192, "fact_user_events": 2, "fact_subscription_daily": 13,
    }


def test_running_again_changes_nothing(spark, raw, warehouse):
    run_etl(spark, str(raw), warehouse, FIRST)
    build_star(spark, warehouse, AS_OF, FIRST)
    before = contents(warehouse)
    again = run_etl(spark, str(raw), warehouse, FIRST)
    build_star(spark, warehouse, AS_OF, FIRST)
    assert again == {"user_profiles": 2, "subscriptions": 0, "transactions": 0, "user_events": 2}
    assert contents(warehouse) == before


def test_snapshot_reload_leaves_plan_and_arr_as_first_seen(spark, raw, warehouse):
    run_etl(spark, str(raw), warehouse, FIRST)
    build_star(spark, warehouse, AS_OF, FIRST)
    rows = json.loads((raw / "subscriptions.json").read_text())
    rows[0].update(plan_name="Enterprise", status="cancelled")
    (raw / "subscriptions.json").write_text(json.dumps(rows))
    run_etl(spark, str(raw), warehouse, SECOND)
    assert warehouse.read("subscriptions").first()["status"] == "active"
    run_etl(spark, str(raw), warehouse, SECOND, upsert_subscriptions=True)
    assert warehouse.read("subscriptions").first()["status"] == "cancelled"
    build_star(spark, warehouse, AS_OF, SECOND)
    row = warehouse.read("fact_subscription_daily").first()
    assert (row["subscription_status"], float(row["mrr"]), row["is_churned"]) == ("cancelled", 299.0, True)
    assert (row["plan_key"], float(row["arr"])) == (3, 1188.0)


def test_missing_sources_are_empty_but_the_gate_fails(spark, raw, warehouse):
    (raw / "transactions.json").write_text("[]")
    with pytest.raises(QualityError, match="row_count: transactions"):
        run_pipeline(spark, str(raw), warehouse, FIRST)
    (raw / "user_events.json").unlink()
    assert run_etl(spark, str(raw), warehouse, FIRST)["user_events"] == 0
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, str(raw), warehouse, FIRST)


def test_only_later_rows_with_since(spark, raw, warehouse):
    loaded = run_etl(spark, str(raw), warehouse, FIRST, since=datetime(2024, 5, 21, 10))
    assert loaded == {"user_profiles": 2, "subscriptions": 0, "transactions": 0, "user_events": 1}


def test_accounts_are_loaded_where_they_exist(spark, raw, warehouse):
    assert "accounts" not in run_etl(spark, str(raw), warehouse, FIRST)
    rows = [{"account_id": "a1", "signup_date": "2024-01-01", "status": "churned"}, {"account_id": "a2", "signup_date": "soon", "status": "active"},
            {"account_id": "a1", "signup_date": "2024-01-02", "status": "active"}, {"account_id": "a3", "status": "churned"}]
    (raw / "accounts.json").write_text(json.dumps(rows))
    assert run_etl(spark, str(raw), warehouse, FIRST)["accounts"] == 3
    got = {r.account_id: (r.signup_date, r.status) for r in warehouse.read("accounts").collect()}
    assert got == {"a1": (datetime(2024, 1, 2), "active"), "a2": (None, "active"), "a3": (None, "churned")}
    assert metrics.churn_rate(warehouse.read("accounts"), AS_OF).first()[0] is not None


def test_stale_data_is_a_warning(spark, raw, warehouse):
    run_etl(spark, str(raw), warehouse, FIRST)
    result = check_quality(spark, warehouse, datetime(2024, 7, 1))
    assert result.success and result.warning_checks == 1


def test_stream_loads_each_file_once(spark, raw, warehouse, tmp_path):
    run_etl(spark, str(raw), warehouse, FIRST)
    schema = "event_id string, user_id string, event_type string, timestamp string, properties string"
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)

    def load(at):
        load_new_event_files(spark, landing, warehouse, progress, at, schema)
        rows = warehouse.read("user_events").collect()
        return {r["event_id"]: (r["event_type"], r["country"], r["ingested_at"]) for r in rows}

    arrive(("e3", "u1", "Click", "2024-05-23T00:00:00", None), ("e1", "u1", "Edited", "2024-05-21T10:00:00", None))
    want = {"e1": ("edited", "DE", FIRST), "e2": ("login", "FR", FIRST), "e3": ("click", "DE", SECOND)}
    assert load(SECOND) == want
    assert load(datetime(2024, 6, 3)) == want
    arrive(("e4", "nobody", "Click", "2024-05-23T00:00:00", None))
    assert load(datetime(2024, 6, 4)) == {**want, "e4": ("click", None, datetime(2024, 6, 4))}


def test_star_fills_plan_runs_from_the_day_before(spark, raw, warehouse):
    """Stored snapshots get their lifecycle columns; a period moved on reads the last day before it."""
    run_etl(spark, str(raw), warehouse, FIRST)
    build_star(spark, warehouse, AS_OF, FIRST)
    runs = {r["date_key"]: r["days_on_current_plan"] for r in warehouse.read("fact_subscription_daily").collect()}
    assert runs == {20240520 + i: i + 1 for i in range(12)} | {20240601: 13}
    build_star(spark, warehouse, date(2024, 7, 5), SECOND)  # its first day is 5 June: no day before is held
    runs = {r["date_key"]: r["days_on_current_plan"] for r in warehouse.read("fact_subscription_daily").collect()}
    assert (runs[20240605], runs[20240705]) == (1, 31)
    build_star(spark, warehouse, date(2024, 8, 5), SECOND)  # goes on from 5 July
    runs = {r["date_key"]: r["days_on_current_plan"] for r in warehouse.read("fact_subscription_daily").collect()}
    assert (runs[20240706], runs[20240805]) == (32, 62)
    signup = {r["date_key"]: r["days_since_signup"] for r in warehouse.read("fact_subscription_daily").collect()}
    assert signup[20240601] == 152


def test_a_run_reports_what_its_cleaning_rejected(spark, raw, warehouse):
    report: dict = {}
    run_etl(spark, str(raw), warehouse, FIRST, report=report)
    assert report["subscriptions"] == {"read": 2, "valid": 1, "kept": 1, "rejected": 1}
    assert report["user_events"] == {"read": 2, "unique": 2, "kept": 2, "rejected": 0}
    assert [report[t]["rejected"] for t in ("user_profiles", "transactions")] == [0, 0]
    (raw / "transactions.json").unlink()
    run_etl(spark, str(raw), warehouse, SECOND, report=report)
    assert report["transactions"] == {"read": 0, "valid": 0, "kept": 0, "rejected": 0}
