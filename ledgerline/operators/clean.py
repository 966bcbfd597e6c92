"""Cleaning of the four sources.

Order matters and differs: events drop copies first and then rows without a time, so an event
whose first copy has no time disappears; the other sources filter first and then drop copies.

`order_by` names the columns that stand for the order of the rows in the source (see
`sources.files`). Within one run the first or last copy wins; a later run wins over what the
warehouse already holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.parsing import parse_money, parse_moment, parse_moment_strict
from ..functions.properties import normalised_properties
from ..schemas import SUBSCRIPTION_STATUSES, TRANSACTION_STATUSES, TRANSACTION_TYPES
from .dedup import keep_first, keep_last


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


class CleaningCounts:
    """Rows seen at each step of one cleaning, counted by the job that runs it anyway.

    Pass a new instance to a cleaner and read `counts` after an action on the result. Counting
    keeps Spark from moving filters past the counting points, hence it is optional.
    """

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        observation = Observation()
        self._observations[step] = observation
        return df.observe(observation, F.count(F.lit(1)).alias("n"))

    @property
    def counts(self) -> dict[str, int]:
        return {step: seen.get["n"] for step, seen in self._observations.items()}


def _watch(counts: CleaningCounts | None, df: DataFrame, step: str) -> DataFrame:
    return df if counts is None else counts.watch(df, step)


def _one_of(column: str, allowed: Sequence[str]) -> Column:
    return F.col(column).isin(*allowed)


def clean_user_events(
    df: DataFrame, order_by: Sequence[str], counts: CleaningCounts | None = None
) -> DataFrame:
    require_columns(df, ["event_id", "user_id", "event_type", "event_ts"])
    read = df.withColumn("event_ts", parse_moment_strict(df, "event_ts"))
    single = keep_first(_watch(counts, read, "read"), ["event_id"], order_by)
    timed = _watch(counts, single, "unique").where(F.col("event_ts").isNotNull())
    return _watch(counts, timed, "kept").withColumns(
        {
            "event_type": F.lower("event_type"),
            "properties": normalised_properties(timed),
        }
    )


def clean_subscriptions(
    df: DataFrame,
    order_by: Sequence[str],
    run_ts: datetime,
    counts: CleaningCounts | None = None,
) -> DataFrame:
    require_columns(df, ["subscription_id", "user_id", "plan_name", "status", "start_date"])
    dates = [c for c in ("start_date", "end_date", "created_at", "updated_at") if c in df.columns]
    read = _watch(counts, df, "read").withColumns({c: parse_moment(df, c) for c in dates})
    if "updated_at" in dates:
        stand_ins = [F.col("created_at")] if "created_at" in dates else []
        now = F.lit(run_ts).cast("timestamp_ntz")
        read = read.withColumn("updated_at", F.coalesce("updated_at", *stand_ins, now))
    valid = read.where(_one_of("status", SUBSCRIPTION_STATUSES))
    if "monthly_revenue" in df.columns:
        revenue = F.coalesce(parse_money("monthly_revenue"), F.lit(0).cast("decimal(10,2)"))
        valid = valid.withColumn("monthly_revenue", revenue).where("monthly_revenue >= 0")
    single = keep_last(_watch(counts, valid, "valid"), ["subscription_id"], order_by)
    return _watch(counts, single, "kept")


def clean_transactions(
    df: DataFrame, order_by: Sequence[str], counts: CleaningCounts | None = None
) -> DataFrame:
    require_columns(df, ["transaction_id", "user_id", "amount", "transaction_type", "status"])
    valid = _watch(counts, df, "read").where(
        _one_of("transaction_type", TRANSACTION_TYPES) & _one_of("status", TRANSACTION_STATUSES)
    )
    if "transaction_date" in df.columns:
        valid = valid.withColumn("transaction_date", parse_moment(df, "transaction_date"))
        valid = valid.where(F.col("transaction_date").isNotNull())
    valid = valid.withColumn("amount", parse_money("amount")).where(F.col("amount").isNotNull())
    single = keep_first(_watch(counts, valid, "valid"), ["transaction_id"], order_by)
    return _watch(counts, single, "kept")


def clean_user_profiles(
    df: DataFrame, order_by: Sequence[str], counts: CleaningCounts | None = None
) -> DataFrame:
    require_columns(df, ["user_id", "email", "created_at"])
    valid = (
        _watch(counts, df, "read")
        .withColumn("created_at", parse_moment(df, "created_at"))
        .where(F.col("created_at").isNotNull() & F.col("email").contains("@"))
    )
    single = keep_last(_watch(counts, valid, "valid"), ["user_id"], order_by)
    return _watch(counts, single, "kept")
