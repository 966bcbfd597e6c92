"""Every query of the engine over the test tables, under the names the oracle uses."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from ledgerline import operators as ops
from ledgerline.functions import normalised_properties, parse_moment, parse_money
from ledgerline.operators import conform, keep_first, keep_last
from ledgerline.operators import quality as checks
from ledgerline.plans import accounts as account_plans
from ledgerline.plans import behaviour, lifecycle, metrics, star, usage
from ledgerline.plans.pipeline import (
    EVENT_UPDATES,
    SNAPSHOT_UPDATES,
    build_star,
    run_etl,
)
from ledgerline.plans.quality_suite import QualitySuite, warehouse_suite
from ledgerline.schemas import (
    FACT_SUBSCRIPTION_DAILY,
    PARTITION_COLUMN,
    PARTITION_RULE,
    SUBSCRIPTION_STATUSES,
    TABLES,
    USER_EVENTS,
)
from ledgerline.session import shared_folder
from ledgerline.sinks import Warehouse
from ledgerline.sinks.warehouse import INDEX_ABOVE
from ledgerline.sources import SOURCES, read_file, read_since
from ledgerline.streaming import load_new_event_files

from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]



def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, the forms every client shows alike."""
    forms = {DecimalType: "double", DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(forms[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in forms
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


WAREHOUSE_TABLES = ["user_profiles", "subscriptions", "transactions", "user_events"]


class Tables:
    """The raw sources, the warehouse tables and the star schema over one folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return b.raw(self.spark, self.sf_dir, name)

    def _build(self, name: str) -> DataFrame:
        raw, order = self.raw(name), b.ORDER_BY[name]
        if name == "user_profiles":
            return ops.clean_user_profiles(raw, order)
        if name == "subscriptions":
            return ops.clean_subscriptions(raw, order, b.RUN_TS)
        if name == "transactions":
            return ops.clean_transactions(raw, order)
        events = ops.clean_user_events(raw, order)
        return ops.enrich_user_events(events, self.profiles, hot_from=raw)

    def __call__(self, name: str) -> DataFrame:
        """A warehouse table as it stands after a load of the raw sources."""
        if name not in WAREHOUSE_TABLES:
            raise KeyError(name)
        if name not in self._built:
            stamp = F.lit(b.RUN_TS).cast("timestamp_ntz")
            self._built[name] = self._build(name).withColumn("ingested_at", stamp)
        return self._built[name]

    def stored(self, name: str) -> DataFrame:
        """The table written once: checks that read it many times clean it once."""
        if name not in self._stored:
            path = f"{shared_folder(self.spark, 'stored')}/{name}"
            df = self(name)
            df.write.parquet(path)
            self._stored[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._stored[name]

    @property
    def events(self) -> DataFrame:
        return self("user_events")

    @property
    def profiles(self) -> DataFrame:
        return self("user_profiles")

    @property
    def subscriptions(self) -> DataFrame:
        return self("subscriptions")

    @property
    def transactions(self) -> DataFrame:
        return self("transactions")

    @property
    def dates(self) -> DataFrame:
        return star.dim_date(self.spark)

    @property
    def plans(self) -> DataFrame:
        return star.dim_plan(self.spark)

    @cached_property
    def dim_account(self) -> DataFrame:
        return star.dim_account(self.profiles)

    @cached_property
    def fact_user_events(self) -> DataFrame:
        return star.fact_user_events(
            self.events, self.profiles, self.dates, hot_from=self.raw("user_events")
        )

    def snapshots(self, days_back: int = 30, dates: DataFrame | None = None) -> DataFrame:
        return star.fact_subscription_daily(
            self.subscriptions,
            self.dim_account,
            self.plans,
            self.dates if dates is None else dates,
            b.AS_OF,
            days_back,
        )


QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Registers a query under its function name, without the trailing underscore if any."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(Tables(spark, sf_dir)))

    QUERIES[build.__name__.rstrip("_")] = run
    return build


def metric(name: str, build: Callable[[Tables], DataFrame]) -> None:
    build.__name__ = name
    query(build)


# Sources


@query
def scan_parquet(t: Tables) -> DataFrame:
    path = f"{t.sf_dir}/orders.parquet"
    return read_file(t.spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )


@query
def scan_incremental(t: Tables) -> DataFrame:
    return read_since(t.raw("user_events"), "event_ts", b.SINCE)


def _written(t: Tables, df: DataFrame, suffix: str) -> str:
    path = f"{shared_folder(t.spark, 'scan')}/raw.{suffix}"
    writer = df.write.option("header", True)
    getattr(writer, suffix)(path)
    return path


@query
def scan_csv(t: Tables) -> DataFrame:
    """Subscriptions written as delimited text and read back as the raw source."""
    return read_file(t.spark, _written(t, t.raw("subscriptions"), "csv"))


# Cleaning


@query
def clean_user_events_(t: Tables) -> DataFrame:
    return ops.clean_user_events(t.raw("dirty_events"), b.ORDER_BY["dirty_events"]).drop("arrival")


@query
def clean_subscriptions(t: Tables) -> DataFrame:
    return t.subscriptions.drop("ingested_at")


@query
def clean_transactions(t: Tables) -> DataFrame:
    return t.transactions.drop("ingested_at", "ord1", "ord2")


@query
def clean_user_profiles(t: Tables) -> DataFrame:
    return t.profiles.drop("ingested_at")


@query
def enrich_user_events_(t: Tables) -> DataFrame:
    return t.events.drop("ingested_at")


@query
def normalise_properties(t: Tables) -> DataFrame:
    raw = t.raw("dirty_events")
    return raw.select("event_id", "arrival", normalised_properties(raw).alias("properties"))


@query
def dedup_first(t: Tables) -> DataFrame:
    first = keep_first(t.raw("transactions"), ["transaction_id"], b.ORDER_BY["transactions"])
    return first.select("transaction_id", "ord1", "amount")


@query
def dedup_last(t: Tables) -> DataFrame:
    last = keep_last(t.raw("transactions"), ["transaction_id"], b.ORDER_BY["transactions"])
    return last.select("transaction_id", "ord1", "amount")


@query
def coerce_types(t: Tables) -> DataFrame:
    """Dates and amounts that arrive as text, some of it unreadable."""
    raw = t.raw("transactions").select(
        "transaction_id",
        "ord1",
        "ord2",
        F.when(F.col("ord1") % 13 == 0, "soon")
        .otherwise(F.col("transaction_date").cast("string"))
        .alias("transaction_date"),
        F.when(F.col("ord2") % 11 == 0, "5d")
        .when(F.col("ord2") % 7 == 0, "1,000")
        .otherwise(F.col("amount").cast("string"))
        .alias("amount"),
    )
    return raw.withColumns(
        {"transaction_date": parse_moment(raw, "transaction_date"), "amount": parse_money("amount")}
    )


# Loads: what the tables hold after a load of overlapping batches of events


def _held_and_batch(t: Tables, events: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Events loaded before a point in time, and a batch from somewhat earlier with new types."""
    events = conform(t.events if events is None else events, USER_EVENTS).drop("event_date")
    held = events.where(F.col("event_ts") <= F.lit(b.SINCE).cast("timestamp_ntz"))
    batch = events.where(F.col("event_ts") > F.lit(b.OVERLAP).cast("timestamp_ntz")).withColumns(
        {
            "event_type": F.concat(F.col("event_type"), F.lit("_v2")),
            "ingested_at": F.lit(b.QUALITY_NOW).cast("timestamp_ntz"),
        }
    )
    return held, batch


def _warehouse(t: Tables, index_above: int = INDEX_ABOVE) -> Warehouse:
    return Warehouse(t.spark, shared_folder(t.spark, "warehouse"), index_above)


def _held_in_warehouse(t: Tables, held: DataFrame, table: str, index_above: int = INDEX_ABOVE) -> Warehouse:
    """A warehouse that holds these rows, stamps included."""
    warehouse = _warehouse(t, index_above)
    prepared = held
    if table in PARTITION_RULE:
        prepared = held.withColumn(PARTITION_COLUMN[table], F.expr(PARTITION_RULE[table]))
    warehouse.write(table, conform(prepared, TABLES[table]))
    return warehouse


@query
def load_insert_new(t: Tables) -> DataFrame:
    held, batch = _held_and_batch(t)
    warehouse = _held_in_warehouse(t, held, "user_events")
    warehouse.insert_new("user_events", batch, ["event_id"], b.QUALITY_NOW)
    return warehouse.read("user_events").drop("event_date")


@query
def load_upsert(t: Tables) -> DataFrame:
    held, batch = _held_and_batch(t)
    warehouse = _held_in_warehouse(t, held, "user_events")
    warehouse.upsert("user_events", batch, ["event_id"], EVENT_UPDATES, b.QUALITY_NOW)
    return warehouse.read("user_events").drop("event_date")


@query
def load_indexed(t: Tables) -> DataFrame:
    """The batch inserted, then upserted, twice, each time with stored keys found through the index."""
    held, batch = _held_and_batch(t, t.stored("user_events"))  # cleaned once for all loads
    warehouse = _held_in_warehouse(t, held, "user_events", index_above=0)
    for _ in range(2):
        warehouse.insert_new("user_events", batch, ["event_id"], b.QUALITY_NOW)
        warehouse.upsert("user_events", batch, ["event_id"], EVENT_UPDATES, b.QUALITY_NOW)
    return warehouse.read("user_events").drop("event_date")


@query
def load_replace(t: Tables) -> DataFrame:
    """Profiles replaced where other profiles were held."""
    old = t.profiles.withColumns({"email": F.lit("old@x"), "user_id": F.concat(F.lit("old"), "user_id")})
    warehouse = _held_in_warehouse(t, old, "user_profiles")
    warehouse.replace("user_profiles", t.profiles, b.RUN_TS)
    return warehouse.read("user_profiles")


@query
def load_upsert_subset(t: Tables) -> DataFrame:
    """Snapshots of one month end, reloaded after every subscription changed plan and status."""
    warehouse = _held_in_warehouse(t, t.snapshots(), "fact_subscription_daily")
    later = t.subscriptions.withColumns(
        {
            "status": F.lit("cancelled"),
            "plan_name": F.when(F.col("plan_name") == "Pro", "Enterprise").otherwise("Pro"),
        }
    )
    batch = star.fact_subscription_daily(
        later, t.dim_account, t.plans, t.dates, b.AS_OF, days_back=10
    )
    keys = ["date_key", "account_key"]
    warehouse.upsert("fact_subscription_daily", batch, keys, SNAPSHOT_UPDATES, b.RUN_TS)
    return warehouse.read("fact_subscription_daily").select(
        "date_key", "account_key", "plan_key", "subscription_status", "mrr", "arr",
        "is_new_subscription", "is_churned",
    )


@query
def evolve_schema(t: Tables) -> DataFrame:
    """Events stored before enrichment existed next to enriched ones, under one schema."""
    old = t.raw("user_events").where(F.col("event_ts") <= F.lit(b.SINCE).cast("timestamp_ntz"))
    new = t.events.where(F.col("event_ts") > F.lit(b.SINCE).cast("timestamp_ntz"))
    both = old.unionByName(new.drop("ingested_at"), allowMissingColumns=True)
    return conform(both, USER_EVENTS).drop("ingested_at", "event_date")


KEY_OF = {
    "user_profiles": "user_id",
    "subscriptions": "subscription_id",
    "transactions": "transaction_id",
    "user_events": "event_id",
}


def raw_folder(t: Tables) -> str:
    """The four raw sources as Parquet files under their raw names.

    Copies of a row stand in one file, in source order; the order of rows that are no copies of each
    other decides nothing. Spark picks the number of files by their size.
    """
    folder = shared_folder(t.spark, "raw")
    for name, spec in SOURCES.items():
        if spec.required:
            df, key = t.raw(name), KEY_OF[name]
            df = df.repartition(key).sortWithinPartitions(key, *b.ORDER_BY[name]).drop("ord1", "ord2")
            names = {logical: raw for raw, logical in spec.renames.items()}
            df.withColumnsRenamed(names).write.parquet(f"{folder}/{name}.parquet")
    return folder


@query
def etl_row_counts(t: Tables) -> DataFrame:
    """What a batch run over raw files reports to have loaded."""
    loaded = run_etl(t.spark, raw_folder(t), _warehouse(t), b.RUN_TS)
    return t.spark.createDataFrame(list(loaded.items()), "table_name string, record_count long")


@query
def etl_load(t: Tables) -> DataFrame:
    """The whole batch run with its writes: files to warehouse, again, and on to star schema.

    The second load must change nothing. Rows per table as stored afterwards, and a digest of
    what they say that does not depend on their order.
    """
    folder = raw_folder(t)
    warehouse = Warehouse(t.spark, shared_folder(t.spark, "warehouse"))
    run_etl(t.spark, folder, warehouse, b.RUN_TS)
    run_etl(t.spark, folder, warehouse, b.RUN_TS)
    build_star(t.spark, warehouse, b.AS_OF, b.RUN_TS)
    told = []
    for name, columns in b.CONTENTS.items():
        text = F.concat_ws("|", *[F.expr(f"coalesce(CAST({c} AS STRING), '~')") for c in columns])
        digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
        sums = F.count(F.lit(1)).alias("record_count"), F.sum(digest).alias("digest")
        told.append(warehouse.read(name).agg(*sums).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionAll, told)


@query
def etl_rejects(t: Tables) -> DataFrame:
    """Rows of each source after each step of its cleaning, as the load's own jobs count them."""
    report: dict[str, dict[str, int]] = {}
    run_etl(t.spark, raw_folder(t), _warehouse(t), b.RUN_TS, report=report)
    rows = [(name, steps["read"], steps["kept"], steps["rejected"]) for name, steps in report.items()]
    return t.spark.createDataFrame(rows, "table_name string, read long, kept long, rejected long")


@query
def etl_incremental(t: Tables) -> DataFrame:
    """Events up to a moment loaded first, later ones by a run with "since"; what is stored then."""
    folder, warehouse = raw_folder(t), _warehouse(t)
    first = shared_folder(t.spark, "raw")
    for name in ("user_profiles", "subscriptions", "transactions"):
        t.spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{first}/{name}.parquet")
    moment = F.lit(b.SINCE).cast("timestamp_ntz")
    events = t.spark.read.parquet(f"{folder}/user_events.parquet")
    events.where(F.col("timestamp") <= moment).write.parquet(f"{first}/user_events.parquet")
    run_etl(t.spark, first, warehouse, b.RUN_TS)
    run_etl(t.spark, folder, warehouse, b.RUN_TS, since=b.SINCE, upsert_subscriptions=True)
    return warehouse.read("user_events").drop("ingested_at", "event_date")


@query
def scan_json(t: Tables) -> DataFrame:
    """Events written as files of JSON lists and read back as the raw source."""
    folder = f"{shared_folder(t.spark, 'scan')}/user_events.json"
    columns = ["event_id", "user_id", "event_type", "properties", "session_id"]
    event = F.struct(*columns, F.col("event_ts").cast("string").alias("timestamp"))
    rows = t.raw("user_events").select(F.to_json(event).alias("o"), F.pmod(F.xxhash64("event_id"), F.lit(64)).alias("part"))
    lists = rows.groupBy("part").agg(F.array_join(F.collect_list("o"), ",").alias("list"))
    lists.select("part", F.concat(F.lit("["), "list", F.lit("]")).alias("value")).write.partitionBy("part").text(folder)
    back = read_file(t.spark, folder, SOURCES["user_events"].raw_schema)
    return back.withColumns(
        {"event_ts": F.col("timestamp").cast("timestamp_ntz"), "properties": F.col("properties").cast("string")}
    ).select(*columns, "event_ts")


@query
def stream_user_events(t: Tables) -> DataFrame:
    """Events loaded by the streaming reader, as stored afterwards."""
    folder = f"{shared_folder(t.spark, 'landing')}/user_events"
    names = {logical: raw for raw, logical in SOURCES["user_events"].renames.items()}
    raw = t.raw("user_events").withColumnsRenamed(names)
    raw.write.parquet(folder)
    warehouse = Warehouse(t.spark, shared_folder(t.spark, "warehouse"))
    warehouse.replace("user_profiles", t.profiles, b.RUN_TS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields)
    checkpoint = shared_folder(t.spark, "progress")
    load_new_event_files(t.spark, folder, warehouse, checkpoint, b.RUN_TS, schema)
    return warehouse.read("user_events").drop("ingested_at", "event_date")


# Star schema


@query
def dim_date(t: Tables) -> DataFrame:
    """The calendar with the number of subscriptions that start on each day."""
    starts = (
        t.subscriptions.groupBy(F.col("start_date").cast("date").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("subscriptions_started"))
    )
    return t.dates.join(starts, "full_date", "left").na.fill(0, ["subscriptions_started"])


@query
def dim_plan(t: Tables) -> DataFrame:
    """The plan tiers with the number of subscriptions on each."""
    used = t.subscriptions.groupBy(F.lower("plan_name").alias("plan_id")).agg(
        F.count(F.lit(1)).alias("subscriptions")
    )
    return t.plans.drop("created_at", "updated_at").join(used, "plan_id", "left").na.fill(
        0, ["subscriptions"]
    )


@query
def dim_account(t: Tables) -> DataFrame:
    return t.dim_account.drop("created_at", "updated_at", "first_paid_date", "churn_date")


@query
def fact_user_events(t: Tables) -> DataFrame:
    return t.fact_user_events.select(
        "event_id", "date_key", "user_id", "event_type", "event_timestamp", "session_id",
        "properties", "country", "is_activation_event", "is_engagement_event",
    )


@query
def fact_subscription_daily(t: Tables) -> DataFrame:
    shown = [c for c in FACT_SUBSCRIPTION_DAILY.names if c not in (
        "loaded_at", "days_since_signup", "days_on_current_plan")]
    return t.snapshots().select(*shown)


@query
def snapshot_mrr_today(t: Tables) -> DataFrame:
    return star.snapshot_totals(t.snapshots(), b.AS_OF)


@query
def star_row_counts(t: Tables) -> DataFrame:
    return metrics.table_counts(
        {
            "dim_account": t.dim_account,
            "dim_plan": t.plans,
            "dim_date": t.dates,
            "fact_user_events": t.fact_user_events,
            "fact_subscription_daily": t.snapshots(),
        }
    )


@query
def mrr_by_month(t: Tables) -> DataFrame:
    """Only month ends of the last 1,000 days are snapshot at all."""
    month_ends = t.dates.where("is_month_end")
    return star.mrr_by_month(t.snapshots(days_back=1000, dates=month_ends), month_ends)


@query
def dau_by_event_type(t: Tables) -> DataFrame:
    return star.daily_active_users(t.fact_user_events, t.dates, b.EVENTS_AS_OF)


@query
def mrr_as_of(t: Tables) -> DataFrame:
    return star.mrr_per_day(t.snapshots())


# Quality


def _suite(t: Tables) -> QualitySuite:
    return QualitySuite(t.spark, t, now=b.QUALITY_NOW)


@query
def dq_row_count(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_row_count("user_events")
        .expect_row_count("subscriptions", min_count=10, max_count=20)
        .expect_row_count("user_profiles", min_count=1, max_count=0)
        .results()
    )


@query
def dq_null_rate(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_no_nulls("user_profiles", ["user_id", "industry"])
        .expect_null_rate("user_events", ["session_id"], 40.0)
        .expect_null_rate("user_profiles", ["company_size", "industry", "email"], 5.0)
        .results()
    )


@query
def dq_duplicates(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_unique("user_events", ["event_id"])
        .expect_unique("transactions", ["subscription_id", "transaction_type"])
        .results()
    )


@query
def dq_referential(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_referential_integrity("subscriptions", "user_id", "user_profiles", "user_id")
        .expect_referential_integrity("user_events", "user_id", "subscriptions", "user_id")
        .results()
    )


@query
def dq_values_in_set(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_values_in_set("subscriptions", "status", SUBSCRIPTION_STATUSES)
        .expect_values_in_set("transactions", "payment_method", ["card"], severity="warning")
        .results()
    )


@query
def dq_value_range(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_value_range("subscriptions", "monthly_revenue", min_value=0)
        .expect_value_range("transactions", "amount", 1000, 50000)
        .expect_value_range("transactions", "amount")
        .results()
    )


@query
def dq_freshness(t: Tables) -> DataFrame:
    return (
        _suite(t)
        .expect_freshness("user_events", "ingested_at", max_age_hours=48)
        .expect_freshness("user_events", "event_ts", max_age_hours=24)
        .results()
    )


@query
def dq_suite(t: Tables) -> DataFrame:
    """Passed and failed checks per severity of a suite over all four tables."""
    return (
        _suite(t)
        .expect_row_count("user_events", min_count=100)
        .expect_no_nulls("user_profiles", ["user_id", "email"])
        .expect_no_nulls("user_events", ["session_id"], severity="warning")
        .expect_unique("transactions", ["transaction_id"])
        .expect_value_range("subscriptions", "monthly_revenue", 0, 298)
        .expect_referential_integrity("user_events", "user_id", "user_profiles", "user_id")
        .results()
        .groupBy("severity", "passed")
        .agg(F.count(F.lit(1)).alias("checks"))
    )


@query
def dq_warehouse_suite(t: Tables) -> DataFrame:
    return warehouse_suite(t.spark, t.stored, b.QUALITY_NOW).results()


@query
def null_required_fields(t: Tables) -> DataFrame:
    columns = {
        "event_id": "null_event_ids",
        "user_id": "null_user_ids",
        "event_ts": "null_timestamps",
    }
    return checks.null_counts(t.raw("dirty_events"), "user_events", columns)


@query
def duplicate_event_ids(t: Tables) -> DataFrame:
    return checks.duplicates(t.raw("dirty_events"), "event_id")


@query
def invalid_date_ranges(t: Tables) -> DataFrame:
    """Subscriptions of which some are made to end before they start."""
    early = F.when(F.col("user_id").endswith("7"), F.expr("start_date - 3")).otherwise(F.col("end_date"))
    return checks.invalid_date_ranges(t.raw("subscriptions").withColumn("end_date", early), "start_date", "end_date")


# Analytics

metric("table_counts", lambda t: metrics.table_counts({n: t(n) for n in WAREHOUSE_TABLES}))
metric(
    "ingestion_recency",
    lambda t: metrics.ingestion_recency(
        {n: t(n) for n in ("user_events", "subscriptions", "transactions")}
    ),
)
metric("users_by_country", lambda t: metrics.users_by_country(t.events))
metric(
    "users_by_country_dashboard",
    lambda t: metrics.users_by_country(t.events).select("country", "active_users"),
)
metric("signup_source_share", lambda t: metrics.signup_source_share(t.profiles))
metric("events_by_type", lambda t: metrics.events_by_type(t.events))
metric("events_by_type_dashboard", lambda t: metrics.event_counts_by_type(t.events))
metric("subscription_status", lambda t: metrics.subscription_status(t.subscriptions))
metric(
    "subscription_status_dashboard",
    lambda t: metrics.subscription_status(t.subscriptions).select(
        "status", F.col("subscription_count").alias("count")
    ),
)
metric("revenue_by_plan", lambda t: metrics.revenue_by_plan(t.subscriptions))
metric("revenue_by_plan_dashboard", lambda t: metrics.mrr_by_plan(t.subscriptions))
metric(
    "subscription_lifecycle", lambda t: metrics.subscription_lifecycle(t.subscriptions, b.NOW)
)
metric("transactions_by_status", lambda t: metrics.transactions_by_status(t.transactions))
metric("revenue_by_type", lambda t: metrics.revenue_by_type(t.transactions))
metric("monthly_revenue", lambda t: metrics.monthly_revenue(t.transactions))
metric("monthly_revenue_dashboard", lambda t: metrics.recent_revenue(t.transactions))
metric("event_demographics", lambda t: metrics.event_demographics(t.events))
metric("feature_usage_by_size", lambda t: metrics.feature_usage_by_size(t.events))
metric("mrr_total", lambda t: metrics.mrr_total(t.subscriptions))
metric(
    "acquisition_by_source",
    lambda t: metrics.acquisition_by_source(t.profiles, t.subscriptions),
)
metric("user_engagement", lambda t: metrics.user_engagement(t.events))
metric("last_ingested", lambda t: metrics.last_ingested(t.events))
metric("mrr_list_price", lambda t: metrics.mrr_list_price(t.subscriptions, t.plans))
metric("churn_rate", lambda t: metrics.churn_rate(t.raw("accounts"), b.EVENTS_AS_OF))


# What follows from the order of things: plan runs, features before upgrades, sessions, trials


@query
def snapshot_lifecycle(t: Tables) -> DataFrame:
    daily = lifecycle.with_lifecycle(t.snapshots(), t.dim_account, t.plans)
    return daily.select(
        "date_key", "account_key", "plan_key", "days_since_signup", "days_on_current_plan",
        "is_expansion", "is_contraction",
    )


@query
def feature_before_upgrade(t: Tables) -> DataFrame:
    return behaviour.feature_before_upgrade(t.events, t.transactions, "$.k")


@query
def features_before_upgrades(t: Tables) -> DataFrame:
    upgrades = behaviour.feature_before_upgrade(t.events, t.transactions, "$.k")
    return behaviour.features_before_upgrades(upgrades, within_days=365)


metric("sessions", lambda t: behaviour.sessions(t.events))
metric("sessions_by_plan", lambda t: behaviour.sessions_by_plan(t.events, t.subscriptions))
metric(
    "trial_conversion",
    lambda t: behaviour.trial_conversion(t.profiles, t.subscriptions, t.transactions),
)


@query
def revenue_retention(t: Tables) -> DataFrame:
    ends = t.dates.where("is_month_end")
    held = t.snapshots(days_back=1000, dates=ends)
    return behaviour.revenue_retention(held, t.dim_account, t.plans, t.dates)


# What is remembered of accounts: milestones merged from batches, and versions of profiles


def _milestones(t: Tables) -> DataFrame:
    """Four batches out of order, one of them twice: the rows of an account are spread over all."""
    state = None
    for n in (3, 1, 0, 2, 1):
        part = F.col("user_id").isNotNull() & (F.pmod(F.xxhash64("user_id", "transaction_date"), F.lit(4)) == n)
        bought = F.pmod(F.xxhash64("user_id", "start_date"), F.lit(4)) == n
        batch = account_plans.milestone_state(t.subscriptions.where(bought), t.transactions.where(part))
        state = batch if state is None else ops.merged_by(state, batch, ["account_id"], account_plans.MILESTONE_RULES)
    return account_plans.account_milestones(t.dim_account, state)


@query
def account_milestones(t: Tables) -> DataFrame:
    return _milestones(t)


@query
def time_to_first_payment(t: Tables) -> DataFrame:
    return account_plans.time_to_first_payment(t.dim_account, _milestones(t))


TRACKED = ["country", "company_size", "role"]


def _account_history(t: Tables) -> DataFrame:
    """Profiles as of three days: some change, some change back, some come later, one day is loaded twice."""
    history = None
    number = F.expr("CAST(substring(user_id, 2) AS BIGINT)")
    for n, day in ((0, "2024-01-01"), (1, "2024-07-01"), (1, "2024-07-01"), (2, "2025-01-01")):
        seen = t.profiles.where(number % 5 != 4 - n)
        moved = (number % 3 == 1) & F.lit(n == 1)
        grown = (number % 4 <= n) & F.lit(n > 0)
        seen = seen.withColumns(
            {
                "country": F.when(moved, "Elsewhere").otherwise(F.col("country")),
                "company_size": F.when(grown, "1000+").otherwise(F.col("company_size")),
            }
        )
        history = ops.with_versions(history, seen, "user_id", TRACKED, F.lit(day).cast("timestamp_ntz"))
    return history


@query
def account_history(t: Tables) -> DataFrame:
    return _account_history(t)


@query
def revenue_by_country_then(t: Tables) -> DataFrame:
    """Payments by the country the payer had at the time."""
    paid = t.transactions.where("transaction_type = 'payment' AND status = 'completed'")
    then = ops.as_of(
        paid.select("user_id", "transaction_date", "amount"), _account_history(t),
        "user_id", "transaction_date", {"country_then": "country"},
    )
    return then.groupBy("country_then").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("revenue")
    )


# Use of the product


@query
def snapshot_usage(t: Tables) -> DataFrame:
    """Snapshots of the month of the events with what their accounts did each day."""
    daily = star.fact_subscription_daily(
        t.subscriptions, t.dim_account, t.plans, t.dates, b.EVENTS_AS_OF
    )
    used = usage.with_usage(daily, t.dim_account, t.events)
    return used.select("date_key", "account_key", "active_users", "total_events")


@query
def weekly_usage(t: Tables) -> DataFrame:
    """Events and users by week and country: exact, and whether the stored days say the same within 5 %."""
    week = F.date_trunc("week", F.col("usage_date")).cast("date")
    stored = usage.usage_of_periods(usage.usage_by_day(t.events, ["country"]), week, ["country"])
    exact = usage.active_users(t.events, F.date_trunc("week", "event_ts").cast("date"), ["country"])
    both = exact.withColumnRenamed("country", "c").join(
        stored, (exact["period"] == stored["period"]) & F.col("c").eqNullSafe(F.col("country"))
    )
    off = F.abs(F.col("active_users_estimate") - F.col("active_users"))
    return both.select(
        exact["period"], "country", "total_events", "active_users",
        (off <= F.col("active_users") * 0.05).alias("estimate_holds"),
    )
