"""Declared schemas of every table, and the values the rules refer to.

Timestamps carry no zone (`timestamp_ntz`), money is decimal, event properties are JSON text.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(10, 2)
ANNUAL_MONEY = DecimalType(12, 2)

# Statuses, types and tiers the rules accept.
SUBSCRIPTION_STATUSES = ["active", "cancelled", "expired", "trial"]
TRANSACTION_TYPES = ["payment", "refund", "upgrade", "downgrade"]
TRANSACTION_STATUSES = ["completed", "pending", "failed"]
ENRICHMENT_COLUMNS = ["country", "signup_source", "company_size"]
CALENDAR_FIRST_DAY = "2023-01-01"
CALENDAR_LAST_DAY = "2028-12-31"
DEFAULT_INDUSTRY = "Technology"
DEFAULT_COMPANY_SIZE = "11-50"
DEFAULT_COUNTRY = "Unknown"
DEFAULT_PLAN_KEY = 1
SNAPSHOT_DAYS_BACK = 30

# The plan tiers (key, id, name, tier, monthly, annual, users, storage, api, priority).
PLAN_TIERS = [
    (1, "free", "Free", 0, "0.00", None, 1, None, False, False),
    (2, "basic", "Basic", 1, "29.00", "290.00", 5, None, False, False),
    (3, "pro", "Pro", 2, "99.00", "990.00", 25, None, True, False),
    (4, "enterprise", "Enterprise", 3, "299.00", "2990.00", None, None, True, True),
]


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_text, _int, _long, _flag = StringType(), IntegerType(), LongType(), BooleanType()
_day, _moment = DateType(), TimestampNTZType()

ACCOUNTS = _struct(
    account_id=_text, company_name=_text, industry=_text, company_size=_text,
    country=_text, signup_date=_moment, status=_text, ingested_at=_moment,
)

USER_PROFILES = _struct(
    user_id=_text, account_id=_text, email=_text, created_at=_moment, signup_source=_text,
    country=_text, role=_text, company_size=_text, industry=_text, ingested_at=_moment,
)

SUBSCRIPTIONS = _struct(
    subscription_id=_text, user_id=_text, plan_name=_text, status=_text, start_date=_moment,
    end_date=_moment, monthly_revenue=MONEY, created_at=_moment, updated_at=_moment,
    ingested_at=_moment,
)

TRANSACTIONS = _struct(
    transaction_id=_text, user_id=_text, subscription_id=_text, amount=MONEY, currency=_text,
    transaction_type=_text, status=_text, transaction_date=_moment, payment_method=_text,
    ingested_at=_moment, transaction_month=_day,
)

USER_EVENTS = _struct(
    event_id=_text, user_id=_text, event_type=_text, event_ts=_moment, properties=_text,
    session_id=_text, country=_text, signup_source=_text, company_size=_text,
    ingested_at=_moment, event_date=_day,
)

DIM_DATE = _struct(
    date_key=_int, full_date=_day, day_of_week=_int, day_of_week_name=_text, day_of_month=_int,
    day_of_year=_int, week_of_year=_int, week_start_date=_day, week_end_date=_day,
    month_number=_int, month_name=_text, month_start_date=_day, month_end_date=_day,
    quarter_number=_int, quarter_name=_text, year_number=_int, fiscal_year=_int,
    fiscal_quarter=_int, is_weekend=_flag, is_month_end=_flag, is_quarter_end=_flag,
    is_year_end=_flag,
)

DIM_PLAN = _struct(
    plan_key=_int, plan_id=_text, plan_name=_text, plan_tier=_int, monthly_price=MONEY,
    annual_price=MONEY, max_users=_int, max_storage_gb=_int, has_api_access=_flag,
    has_priority_support=_flag, is_active=_flag, created_at=_moment, updated_at=_moment,
)

DIM_ACCOUNT = _struct(
    account_key=_long, account_id=_text, company_name=_text, industry=_text, company_size=_text,
    country=_text, status=_text, signup_date=_moment, first_paid_date=_moment,
    churn_date=_moment, created_at=_moment, updated_at=_moment,
)

FACT_SUBSCRIPTION_DAILY = _struct(
    account_key=_long, plan_key=_int, subscription_status=_text, mrr=MONEY, arr=ANNUAL_MONEY,
    active_users=_int, total_events=_int, is_new_subscription=_flag, is_churned=_flag,
    is_expansion=_flag, is_contraction=_flag, days_since_signup=_int, days_on_current_plan=_int,
    loaded_at=_moment, date_key=_int,
)

FACT_USER_EVENTS = _struct(
    event_key=_long, event_id=_text, account_key=_long, user_id=_text, event_type=_text,
    event_timestamp=_moment, session_id=_text, properties=_text, country=_text, plan_name=_text,
    is_activation_event=_flag, is_engagement_event=_flag, loaded_at=_moment, date_key=_int,
)

# Creation order: operational tables, then dimensions, then the facts that refer to them.
TABLES: dict[str, StructType] = {
    "accounts": ACCOUNTS,
    "user_profiles": USER_PROFILES,
    "subscriptions": SUBSCRIPTIONS,
    "transactions": TRANSACTIONS,
    "user_events": USER_EVENTS,
    "dim_date": DIM_DATE,
    "dim_plan": DIM_PLAN,
    "dim_account": DIM_ACCOUNT,
    "fact_subscription_daily": FACT_SUBSCRIPTION_DAILY,
    "fact_user_events": FACT_USER_EVENTS,
}

# Only tables that grow with time are partitioned, by a column of few values per run.
PARTITION_COLUMN = {
    "transactions": "transaction_month",
    "user_events": "event_date",
    "fact_subscription_daily": "date_key",
    "fact_user_events": "date_key",
}

# How a partition column follows from the row, for tables where it is not part of the batch.
PARTITION_RULE = {
    "transactions": "cast(trunc(transaction_date, 'MONTH') as date)",
    "user_events": "cast(event_ts as date)",
}

STAR_TABLES = ["dim_account", "dim_plan", "dim_date", "fact_user_events", "fact_subscription_daily"]
