"""Times the engine on one folder of test tables and prints one JSON line.

First the whole batch run, files to warehouse to star schema, on empty tables and again on
loaded ones; then the quality suite and every analytics question over the stored tables; then
queries that start from the raw tables. Every query result is computed in full and dropped.
Queries: median of BENCH_RUNS runs after one to warm up. Batch runs: one run each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import metrics, star
from ledgerline.plans.pipeline import build_star, run_etl
from ledgerline.plans.quality_suite import warehouse_suite
from ledgerline.session import configure
from ledgerline.sinks import Warehouse
from workload import bindings as b
from workload.queries import QUERIES, Tables, raw_folder

FROM_RAW = [
    "scan_incremental", "clean_user_events", "clean_subscriptions", "clean_transactions",
    "clean_user_profiles", "enrich_user_events", "load_upsert", "dim_account",
    "fact_user_events", "fact_subscription_daily", "mrr_by_month", "dq_warehouse_suite",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="/tmp/run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return configure(spark)


def stored_queries(spark: SparkSession, warehouse: Warehouse) -> dict:
    def t(name: str) -> DataFrame:
        return warehouse.read(name)

    four = ["user_events", "subscriptions", "transactions", "user_profiles"]
    return {
        "table_counts": lambda: metrics.table_counts({n: t(n) for n in four}),
        "ingestion_recency": lambda: metrics.ingestion_recency({n: t(n) for n in four[:3]}),
        "users_by_country": lambda: metrics.users_by_country(t("user_events")),
        "signup_source_share": lambda: metrics.signup_source_share(t("user_profiles")),
        "events_by_type": lambda: metrics.events_by_type(t("user_events")),
        "subscription_status": lambda: metrics.subscription_status(t("subscriptions")),
        "revenue_by_plan": lambda: metrics.revenue_by_plan(t("subscriptions")),
        "subscription_lifecycle": lambda: metrics.subscription_lifecycle(t("subscriptions"), b.NOW),
        "transactions_by_status": lambda: metrics.transactions_by_status(t("transactions")),
        "revenue_by_type": lambda: metrics.revenue_by_type(t("transactions")),
        "monthly_revenue": lambda: metrics.monthly_revenue(t("transactions")),
        "event_demographics": lambda: metrics.event_demographics(t("user_events")),
        "feature_usage_by_size": lambda: metrics.feature_usage_by_size(t("user_events")),
        "mrr_total": lambda: metrics.mrr_total(t("subscriptions")),
        "acquisition_by_source": lambda: metrics.acquisition_by_source(
            t("user_profiles"), t("subscriptions")
        ),
        "user_engagement": lambda: metrics.user_engagement(t("user_events")),
        "last_ingested": lambda: metrics.last_ingested(t("user_events")),
        "mrr_list_price": lambda: metrics.mrr_list_price(t("subscriptions"), t("dim_plan")),
        "mrr_by_month": lambda: star.mrr_by_month(t("fact_subscription_daily"), t("dim_date")),
        "mrr_per_day": lambda: star.mrr_per_day(t("fact_subscription_daily")),
        "dau_by_event_type": lambda: star.daily_active_users(
            t("fact_user_events"), t("dim_date"), b.EVENTS_AS_OF
        ),
        "dq_warehouse_suite": lambda: warehouse_suite(spark, t, b.QUALITY_NOW).results(),
    }


def clock(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    times: dict[str, float] = {}

    folder = raw_folder(Tables(spark, sf_dir))
    # A run over the smallest tables first, so that the timed one finds a warm JVM.
    small = raw_folder(Tables(spark, str(Path(sf_dir).parent / "sf0.001")))
    trial = Warehouse(spark, tempfile.mkdtemp(prefix="/tmp/run-"))
    run_etl(spark, small, trial, b.RUN_TS)
    build_star(spark, trial, b.AS_OF, b.RUN_TS)

    warehouse = Warehouse(spark, tempfile.mkdtemp(prefix="/tmp/run-"))
    for name in ("first", "again"):
        times[f"etl_{name}"] = clock(lambda: run_etl(spark, folder, warehouse, b.RUN_TS))
        times[f"star_{name}"] = clock(lambda: build_star(spark, warehouse, b.AS_OF, b.RUN_TS))

    # The usual case: a small batch on loaded tables. One hundredth of the events' time span.
    low, high = warehouse.read("user_events").agg(F.min("event_ts"), F.max("event_ts")).first()
    since = high - (high - low) / 100
    times["etl_one_percent"] = clock(
        lambda: run_etl(spark, folder, warehouse, b.RUN_TS, since=since, upsert_subscriptions=True)
    )

    def timed(name: str, build) -> None:
        drain(build())
        times[name] = statistics.median(clock(lambda: drain(build())) for _ in range(runs))

    for name, build in stored_queries(spark, warehouse).items():
        timed(f"stored_{name}", build)
    for name in FROM_RAW:
        timed(f"raw_{name}", lambda name=name: QUERIES[name](spark, sf_dir))

    report = {
        "metric": "total seconds over batch runs and queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
