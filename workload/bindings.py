"""The test tables seen as raw sources of a subscription business.

The texts run unchanged in Spark and in the SQL oracle, so both sides start from the same rows.
Dates of orders move forward 28 years, which keeps leap years and weekdays and puts most of them
inside the calendar dimension. Bad rows occur throughout: invalid e-mails, unknown statuses,
missing and negative revenue, plans without a tier, repeated transaction ids.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import configure

AS_OF = date(2026, 6, 30)
NOW = datetime(2026, 6, 30, 0, 0, 0)
EVENTS_AS_OF = date(2024, 1, 31)
RUN_TS = datetime(2024, 2, 1, 0, 0, 0)
QUALITY_NOW = datetime(2024, 2, 2, 12, 0, 0)
SINCE = datetime(2024, 1, 16, 0, 0, 0)
OVERLAP = datetime(2024, 1, 10, 0, 0, 0)

USER_PROFILES = """
SELECT concat('u', CAST(c_custkey AS STRING)) AS user_id,
  concat('a', CAST(c_custkey % 200 AS STRING)) AS account_id,
  CASE WHEN c_custkey % 97 = 0 THEN 'invalid'
    ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS email,
  DATE '2023-01-01' + CAST(c_custkey % 365 AS INT) AS created_at,
  CASE c_custkey % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid' ELSE 'referral' END AS signup_source,
  n_name AS country,
  CASE c_custkey % 4 WHEN 0 THEN 'admin' WHEN 1 THEN 'viewer' ELSE 'member' END AS role,
  CASE c_mktsegment WHEN 'BUILDING' THEN '1-10' WHEN 'MACHINERY' THEN '51-200'
    WHEN 'FURNITURE' THEN '201-1000' WHEN 'HOUSEHOLD' THEN '1000+' ELSE NULL END AS company_size,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS industry
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

SUBSCRIPTIONS = """
SELECT subscription_id, user_id, plan_name, status, start_date, end_date, monthly_revenue,
  start_date AS created_at,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE end_date END AS updated_at
FROM (
  SELECT o_orderkey, concat('s', CAST(o_orderkey AS STRING)) AS subscription_id,
    concat('u', CAST(o_custkey AS STRING)) AS user_id, plan_name, status, start_date,
    CASE WHEN status = 'active' THEN NULL WHEN status = 'trial' THEN start_date + 14
      ELSE start_date + CAST(30 + o_orderkey % 336 AS INT) END AS end_date,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL
      WHEN o_orderkey % 101 = 0 THEN CAST(-1 AS DECIMAL(10,2))
      ELSE CAST(CASE plan_name WHEN 'Enterprise' THEN 299 WHEN 'Pro' THEN 99 WHEN 'Basic' THEN 29
        ELSE 0 END AS DECIMAL(10,2)) END AS monthly_revenue
  FROM (
    SELECT o_orderkey, o_custkey, CAST(o_orderdate + INTERVAL '28' YEAR AS DATE) AS start_date,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN 'Pro'
        WHEN '3-MEDIUM' THEN 'Basic' WHEN '5-LOW' THEN 'Free' ELSE 'Legacy' END AS plan_name,
      CASE WHEN o_orderkey % 50 = 0 THEN 'paused' WHEN o_orderstatus = 'O' THEN 'active'
        WHEN o_orderstatus = 'P' THEN 'trial' WHEN o_orderkey % 2 = 0 THEN 'cancelled'
        ELSE 'expired' END AS status
    FROM orders
  ) o
) s
"""

TRANSACTIONS = """
SELECT concat('t', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
  concat('u', CAST(o_custkey AS STRING)) AS user_id,
  concat('s', CAST(l_orderkey AS STRING)) AS subscription_id,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, 'USD' AS currency,
  CASE WHEN l_returnflag = 'R' THEN 'refund' WHEN l_returnflag = 'A' THEN 'payment'
    WHEN l_linestatus = 'O' THEN 'upgrade' ELSE 'downgrade' END AS transaction_type,
  CASE WHEN l_partkey % 50 = 0 THEN 'failed' WHEN l_partkey % 12 = 0 THEN 'pending'
    ELSE 'completed' END AS status,
  CAST(l_shipdate + INTERVAL '28' YEAR AS DATE) AS transaction_date,
  CASE l_partkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'bank' ELSE NULL END AS payment_method,
  l_partkey AS ord1, l_suppkey AS ord2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

USER_EVENTS = """
SELECT concat('e', CAST(event_id AS STRING)) AS event_id,
  concat('u', CAST(user_id AS STRING)) AS user_id,
  CASE event_type WHEN 'view' THEN 'Page_View' WHEN 'error' THEN 'feature_used'
    ELSE event_type END AS event_type,
  ts AS event_ts, props AS properties,
  CASE WHEN event_id % 10 < 7
    THEN concat('x', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING))
    ELSE NULL END AS session_id
FROM events
"""

# Every event twice: as delivered, with some times and properties broken, and as a later copy.
DIRTY_EVENTS = """
SELECT concat('e', CAST(event_id AS STRING)) AS event_id,
  concat('u', CAST(user_id AS STRING)) AS user_id,
  CASE event_type WHEN 'view' THEN 'Page_View' ELSE event_type END AS event_type,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts END AS event_ts,
  CASE WHEN event_id % 37 = 0 THEN 'not json' WHEN event_id % 41 = 0 THEN NULL
    WHEN event_id % 43 = 0 THEN concat(props, ' x') WHEN event_id % 47 = 0 THEN '[1]'
    ELSE props END AS properties, 0 AS arrival
FROM events
UNION ALL
SELECT concat('e', CAST(event_id AS STRING)), concat('u', CAST(user_id AS STRING)), 'COPY', ts,
  props, 1
FROM events
"""

ACCOUNTS = """
SELECT concat('a', CAST(c_custkey AS STRING)) AS account_id, c_name AS company_name,
  c_mktsegment AS industry,
  CASE WHEN c_custkey % 20 < 3 THEN 'churned' WHEN c_custkey % 20 < 6 THEN 'trial'
    ELSE 'active' END AS status,
  DATE '2023-01-01' + CAST(c_custkey % 365 AS INT) AS signup_date
FROM customer
"""

BINDINGS = {
    "user_profiles": USER_PROFILES,
    "subscriptions": SUBSCRIPTIONS,
    "transactions": TRANSACTIONS,
    "user_events": USER_EVENTS,
    "dirty_events": DIRTY_EVENTS,
    "accounts": ACCOUNTS,
}

TABLES_OF = {
    "user_profiles": ("customer", "nation"),
    "subscriptions": ("orders",),
    "transactions": ("lineitem", "orders"),
    "user_events": ("events",),
    "dirty_events": ("events",),
    "accounts": ("customer",),
}

# What stands for the order of the rows in each source.
ORDER_BY = {
    "user_profiles": ["created_at", "email"],
    "subscriptions": ["start_date", "user_id"],
    "transactions": ["ord1", "ord2", "transaction_date", "amount", "transaction_type"],
    "user_events": ["event_ts"],
    "dirty_events": ["arrival"],
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw source over the test tables of a folder."""
    configure(spark)
    views = {}
    text = BINDINGS[name]
    for table in TABLES_OF[name]:
        views[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {table}", f"{word} {{{table}}}")
    return spark.sql(text, **views)

#: What the stored tables are compared by, as expressions that Spark and SQL share.
CONTENTS = {
    "user_profiles": ["user_id", "account_id", "email", "signup_source", "country", "role", "company_size", "industry"],
    "subscriptions": ["subscription_id", "user_id", "plan_name", "status", "CAST(start_date AS DATE)", "CAST(monthly_revenue * 100 AS BIGINT)"],
    "transactions": [
        "transaction_id", "user_id", "subscription_id", "CAST(CAST(amount AS DECIMAL(10,2)) * 100 AS BIGINT)", "currency",
        "transaction_type", "status", "CAST(transaction_date AS DATE)", "payment_method",
    ],
    "user_events": ["event_id", "user_id", "event_type", "session_id", "country", "signup_source", "company_size", "CAST(event_ts AS DATE)"],
    "dim_date": ["date_key", "month_name", "quarter_name", "fiscal_year", "fiscal_quarter", "is_weekend"],
    "dim_plan": ["plan_key", "plan_id", "plan_tier", "max_users"],
    "dim_account": ["account_id", "country", "company_size", "industry"],
    "fact_user_events": ["event_id", "user_id", "event_type", "session_id", "country", "date_key"],
    "fact_subscription_daily": ["date_key", "plan_key", "subscription_status", "CAST(mrr * 100 AS BIGINT)"],
}
