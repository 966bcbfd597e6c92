"""Dense surrogate keys in order of a natural key, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_PER_RANGE = 32


def _range_bounds(df: DataFrame, natural_key: str, ranges: int) -> list[str]:
    """At most `ranges - 1` values that cut the natural keys into ranges of similar size.

    The sample is the keys with the smallest hashes: the same ones whenever it is taken, spread
    evenly over the keys, and of fixed size.
    """
    sample = (
        df.select(natural_key)
        .distinct()
        .orderBy(F.xxhash64(natural_key), natural_key)
        .limit(ranges * SAMPLE_PER_RANGE)
    )
    picks = F.array_sort(F.collect_list(natural_key))
    row = sample.agg(picks.alias("picks")).first()
    values = row["picks"] if row else []
    step = max(1, len(values) // ranges)
    return values[step::step][: ranges - 1]


def _range_of(key: Column, bounds: list[str]) -> Column:
    """Number of bounds up to `key`, by halving: as many steps as the number of bounds has bits."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b) for b in bounds]).cast("array<string>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def take(at: Column, step: Column) -> Column:
        return F.when(F.get(held, at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), take)


def with_dense_keys(
    df: DataFrame, natural_key: str, key: str, start: int = 1, ranges: int | None = None
) -> DataFrame:
    """`df` plus `key` = start, start+1, ... in ascending order of the unique `natural_key`.

    Rows are cut into ranges of the natural key, numbered inside each range in parallel, and
    shifted by the number of rows in the ranges before. Range membership follows from the key
    alone, so a recomputed task yields the same numbers.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = _range_of(F.col(natural_key), _range_bounds(df, natural_key, ranges))
    placed = df.withColumn("_range", position)

    # One row per range: the running total over at most `ranges` rows is a single small task.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        placed.groupBy("_range")
        .count()
        .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_range").orderBy(natural_key)
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(shift), "_range")
        .withColumn(key, (F.col("_shift") + F.col("_place") - 1 + start).cast("bigint"))
        .select(key, *df.columns)
    )
