"""The batch runs: raw files to warehouse tables, warehouse tables to star schema."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_moment
from ..operators.clean import (
    CleaningCounts,
    clean_subscriptions,
    clean_transactions,
    clean_user_events,
    clean_user_profiles,
)
from ..operators.dedup import keep_last
from ..operators.enrich import enrich_user_events
from ..schemas import SNAPSHOT_DAYS_BACK, STAR_TABLES
from ..session import configure
from ..sinks.warehouse import Warehouse
from ..sources.files import ROW_ORDER, check_sources, read_source, resolve_source
from ..sources.paths import exists
from . import star
from .lifecycle import stored_before, with_lifecycle
from .metrics import table_counts
from .quality_suite import SuiteResult, warehouse_suite
from .usage import with_usage

log = logging.getLogger(__name__)

EVENT_UPDATES = [
    "user_id", "event_type", "event_ts", "properties", "session_id", "country",
    "signup_source", "company_size",
]
SUBSCRIPTION_UPDATES = [
    "user_id", "plan_name", "status", "start_date", "end_date", "monthly_revenue", "created_at",
    "updated_at",
]
SNAPSHOT_UPDATES = ["subscription_status", "mrr", "is_churned"]
# Events may come after the snapshot of their day.
USAGE_UPDATES = ["active_users", "total_events"]


def load_user_events(
    warehouse: Warehouse, raw: DataFrame, profiles: DataFrame | None, run_ts: datetime,
    order_by: Sequence[str] = ROW_ORDER, counts: CleaningCounts | None = None,
) -> int:
    """Cleans, enriches and upserts one batch of raw events."""
    events = clean_user_events(raw, order_by, counts)
    enriched = enrich_user_events(events, profiles, hot_from=raw)
    return warehouse.upsert("user_events", enriched, ["event_id"], EVENT_UPDATES, run_ts)


def _together(*loads: Callable[[], Any]) -> list[Any]:
    """Runs loads that do not depend on each other at the same time, so that the last tasks of
    one do not leave the cluster idle. All finish before an error of one is raised."""
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        running = [pool.submit(load) for load in loads]
    return [load.result() for load in running]


def run_etl(
    spark: SparkSession,
    raw_dir: str,
    warehouse: Warehouse,
    run_ts: datetime,
    since: datetime | None = None,
    upsert_subscriptions: bool = False,
    report: dict[str, dict[str, int]] | None = None,
) -> dict[str, int]:
    """Loads the four sources of a folder; returns rows loaded per table.

    Profiles are replaced, subscriptions and transactions get their new rows, events are
    upserted, accounts are replaced where the folder has them. A source that is missing counts as
    empty. With `since`, only later rows of the
    sources that have a time column are read. Subscriptions already held stay as they are, even
    if the source has a later version of them; `upsert_subscriptions` updates them instead, and
    "since" then goes by when they changed.

    `report`, if given, receives for each of the four sources how many rows its cleaning left after
    each step and how many it rejected in all. The load's own jobs count them.
    """
    configure(spark)
    counts = {} if report is None else {t: CleaningCounts() for t in ("user_profiles", "subscriptions", "transactions", "user_events")}

    def source(name: str, changed: bool = False) -> DataFrame:
        return read_source(spark, raw_dir, name, since, changed)

    def profiles() -> int:
        cleaned = clean_user_profiles(source("user_profiles"), ROW_ORDER, counts.get("user_profiles"))
        return warehouse.replace("user_profiles", cleaned, run_ts)

    def subscriptions() -> int:
        raw = source("subscriptions", upsert_subscriptions)
        cleaned = clean_subscriptions(raw, ROW_ORDER, run_ts, counts.get("subscriptions"))
        key = ["subscription_id"]
        if upsert_subscriptions:
            return warehouse.upsert("subscriptions", cleaned, key, SUBSCRIPTION_UPDATES, run_ts)
        return warehouse.insert_new("subscriptions", cleaned, key, run_ts)

    def transactions() -> int:
        cleaned = clean_transactions(source("transactions"), ROW_ORDER, counts.get("transactions"))
        return warehouse.insert_new("transactions", cleaned, ["transaction_id"], run_ts)

    def profiles_then_events() -> tuple[int, int]:
        people = profiles()
        # The profiles just written: clean, one per user, of a size Spark knows from the files.
        known = warehouse.read("user_profiles") if people else None
        seen = counts.get("user_events")
        return people, load_user_events(warehouse, source("user_events"), known, run_ts, counts=seen)

    def accounts() -> int | None:
        """Accounts are optional: a folder without them leaves the table as it is."""
        if not exists(spark, resolve_source(spark, raw_dir, "accounts")):
            return None
        raw = read_source(spark, raw_dir, "accounts").where(F.col("account_id").isNotNull())
        known = keep_last(raw, ["account_id"], ROW_ORDER)
        known = known.withColumn("signup_date", parse_moment(known, "signup_date"))
        return warehouse.replace("accounts", known.drop(*ROW_ORDER), run_ts)

    (people, events), subscribed, paid, companies = _together(
        profiles_then_events, subscriptions, transactions, accounts
    )
    loaded = {
        "user_profiles": people,
        "subscriptions": subscribed,
        "transactions": paid,
        "user_events": events,
    }
    if companies is not None:
        loaded["accounts"] = companies
    for table, watched in counts.items():
        steps = watched.counts
        report[table] = {**steps, "rejected": steps["read"] - steps["kept"]}
        log.info("Cleaned %s: %s", table, report[table])
    for table, rows in loaded.items():
        log.info("Loaded %s rows to %s", f"{rows:,}", table)
    return loaded


def build_star(
    spark: SparkSession, warehouse: Warehouse, as_of: date, run_ts: datetime
) -> dict[str, int]:
    """Builds or extends dimensions, then facts; returns rows held per star table."""
    configure(spark)
    profiles = warehouse.read("user_profiles")

    def accounts() -> int:
        held = warehouse.read("dim_account")
        return warehouse.write("dim_account", star.dim_account(profiles, run_ts, held))

    _together(
        lambda: warehouse.insert_new("dim_date", star.dim_date(spark), ["date_key"], run_ts),
        lambda: warehouse.insert_new("dim_plan", star.dim_plan(spark, run_ts), ["plan_id"], run_ts),
        accounts,
    )
    dates = warehouse.read("dim_date")

    def events() -> int:
        # Facts held already are sorted out before anything else is done for the others.
        stored, held = warehouse.read("user_events"), warehouse.read("fact_user_events")
        new = star.fact_user_events(stored, profiles, dates, run_ts, held, hot_from=stored)
        return warehouse.write("fact_user_events", new, sequence="event_key")

    def snapshots() -> int:
        companies, plans = warehouse.read("dim_account"), warehouse.read("dim_plan")
        daily = star.fact_subscription_daily(
            warehouse.read("subscriptions"), companies, plans, dates, as_of, run_ts=run_ts
        )
        first_day = as_of - timedelta(days=SNAPSHOT_DAYS_BACK)
        before = stored_before(warehouse.read("fact_subscription_daily"), first_day)
        facts = with_lifecycle(daily, companies, plans, before)
        days = F.col("event_date").between(F.lit(first_day), F.lit(as_of))
        facts = with_usage(facts, companies, warehouse.read("user_events").where(days))
        keys = ["date_key", "account_key"]
        updates = [*SNAPSHOT_UPDATES, *USAGE_UPDATES]
        return warehouse.upsert("fact_subscription_daily", facts, keys, updates, run_ts)

    _together(events, snapshots)
    counts = table_counts({t: warehouse.read(t) for t in STAR_TABLES}).collect()
    return {row["table_name"]: row["record_count"] for row in counts}


def check_quality(spark: SparkSession, warehouse: Warehouse, now: datetime) -> SuiteResult:
    """Runs the warehouse suite; raises if it fails."""
    result = warehouse_suite(spark, warehouse.read, now).run()
    for check in result.results:
        log.log(logging.INFO if check.passed else logging.WARNING, "%s", check)
    result.raise_if_failed()
    return result


def run_pipeline(
    spark: SparkSession, raw_dir: str, warehouse: Warehouse, run_ts: datetime
) -> tuple[dict[str, int], SuiteResult]:
    """Checks that the sources are there, loads them, and gates the load on its quality."""
    check_sources(spark, raw_dir)
    loaded = run_etl(spark, raw_dir, warehouse, run_ts)
    return loaded, check_quality(spark, warehouse, run_ts)
