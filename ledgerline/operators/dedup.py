"""Keep one row per key.

Rows of a distributed table have no order of their own, so the caller always names the columns
that define it; they should order the copies of a key completely.

Spark plans a rank filter of 1 with a partial limit per key below the shuffle, so each map task
sends at most one row per key: a key that fills a third of the table costs no more than any
other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_copy_rank"


def _keep_one(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    if not order:
        raise ValueError("an order is needed to say which copy of a key to keep")
    copies = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(copies)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return _keep_one(df, key, [F.col(c).asc_nulls_first() for c in order_by])


def keep_last(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return _keep_one(df, key, [F.col(c).desc_nulls_last() for c in order_by])
