"""Left join of a large table to a table with one row per key, safe against hot keys.

A plain shuffle join sends all rows of one key to one task. Here the most frequent keys are
taken out first:

1. frequent-items sketches over the key column name at most `HOT_KEYS` candidates. Each task
   makes one small sketch, sketches merge into a fixed number of groups, and the best of the
   groups' few candidates are kept. No rows are shuffled, and the driver receives the names;
2. the candidates' rows of the lookup table, at most `HOT_KEYS` of them since a key has one row,
   are broadcast;
3. all other rows join by shuffle. Rows already served, and rows without a key, travel under
   spread-out keys that match nothing, so that they fill all tasks evenly.

Which keys the sketches name affects speed only: a row gets the same values on either path. If
Spark's own size estimate puts the lookup table below the session's broadcast limit, none of
this is needed and a plain join is planned, which Spark then broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 64
# With 512 counters a sketch is sure to hold every value above 0.7 % of its rows.
SKETCH_COUNTERS = 512
SKETCH_GROUPS = 256
SPREAD = 65536


def hot_keys(df: DataFrame, key: str, at_most: int = HOT_KEYS) -> list[str]:
    """At most `at_most` non-null values of `key`, among them every value that fills much of it."""
    per_group = (
        df.select(key)
        .groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part"))
        .agg(F.expr(f"approx_top_k(`{key}`, {int(at_most)}, {SKETCH_COUNTERS})").alias("top"))
    )
    top = (
        per_group.select(F.inline("top"))
        .where(F.col("item").isNotNull())
        .groupBy("item")
        .agg(F.sum("count").alias("n"))
        .orderBy(F.desc("n"), "item")
        .limit(at_most)
    )
    return [row["item"] for row in top.collect()]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate of `df` is within the session's broadcast limit."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit


def skew_safe_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    columns: Sequence[str],
    spread_by: str,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """`df` with `columns` of the row of `lookup` that has the same `key`, null where none has.

    `lookup` must hold each key once, and keys are text. `spread_by` is a column of `df` with
    many values. `hot_from` is where to look for frequent keys when `df` itself is costly to
    compute, for example the raw source it was cleaned from.
    """
    slim = lookup.select(key, *columns)
    if fits_broadcast(slim):
        return df.join(slim, key, "left").select(*df.columns, *columns)
    hot = hot_keys(df if hot_from is None else hot_from, key)

    def renamed(prefix: str) -> DataFrame:
        return slim.select(
            F.col(key).alias(f"{prefix}key"), *[F.col(c).alias(prefix + c) for c in columns]
        )

    hot_rows = renamed("_hot_").where(F.col("_hot_key").isin(*hot))
    # Hot or null: answered by the broadcast, if at all.
    apart = F.coalesce(F.col(key).isin(*hot), F.lit(True))
    spread_key = F.concat(
        F.lit("spread-"), F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("string")
    )
    served = (
        df.join(F.broadcast(hot_rows), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_apart", apart)
        .withColumn("_travel_key", F.when(F.col("_apart"), spread_key).otherwise(F.col(key)))
    )
    # The second condition keeps a spread-out key from ever meeting a real one of the same text.
    meets = (F.col("_travel_key") == F.col("_cold_key")) & ~F.col("_apart")
    found = [
        F.when(F.col("_apart"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c)
        for c in columns
    ]
    return served.join(renamed("_cold_"), meets, "left").select(*df.columns, *found)
