"""As-of join: to each row the last row of another table that came before it, key by key.

Both tables are put on top of each other and sorted by time; the last value is carried forward. No
range or nested-loop join is needed. Time is cut into buckets, so that no task sorts all rows of a key:
rows meet within a bucket only where the left side has a row there, and of all earlier buckets just one
row each, aggregated map-side, is carried on. A key with a third of all rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_last(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    tie: str,
    values: Mapping[str, Column | str],
    strictly: bool = False,
    bucket: str = "hour",
) -> DataFrame:
    """`left` plus `values` of the last row of `right` with the same `key`, not after `left_time`.

    `strictly` leaves out rows at the very same time. Of rows at one time the highest `tie` counts;
    `values` names columns of `right`. Every row of `left` is kept once, also rows that repeat; values
    are null where nothing came before, and where a key or time is null. `bucket` is a unit of
    `date_trunc`; it changes the amount of work only.
    """
    def timed(df: DataFrame, time: str) -> DataFrame:
        at = F.col(f"`{time}`").cast("timestamp_ntz")
        return df.withColumns({"_key": F.col(f"`{key}`"), "_at": at, "_bucket": F.date_trunc(bucket, at)})

    rows = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"), f"`{key}`", f"`{left_time}`")
    rows = timed(rows, left_time).select("_row", "_key", "_at", "_bucket")
    usable = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    placed = rows.where(usable)
    fields = [(F.expr(v) if isinstance(v, str) else v).alias(n) for n, v in values.items()]
    found = timed(right, right_time).where(usable).select(
        "_key", "_at", "_bucket", F.struct(F.col("_at").alias("_at"), F.col(f"`{tie}`").alias("_tie"), *fields).alias("_found")
    )

    # What each bucket of the left side inherits: the last row of all buckets before it.
    wanted = placed.select("_key", "_bucket").distinct()
    newest = found.groupBy("_key", "_bucket").agg(F.max("_found").alias("_found"))
    both = newest.unionByName(wanted, allowMissingColumns=True).groupBy("_key", "_bucket").agg(F.max("_found").alias("_found"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inherited = both.withColumn("_carried", F.max("_found").over(before)).where("_carried IS NOT NULL").select("_key", "_bucket", "_carried")

    # Within a bucket: both sides in one order, the last row so far carried forward.
    near = found.join(wanted, ["_key", "_bucket"], "left_semi").withColumn("_side", F.lit(1 if strictly else 0))
    stream = placed.withColumn("_side", F.lit(0 if strictly else 1)).unionByName(near, allowMissingColumns=True)
    upto = Window.partitionBy("_key", "_bucket").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = stream.withColumn("_last", F.max("_found").over(upto)).where("_row IS NOT NULL")

    joined = matched.join(inherited, ["_key", "_bucket"], "left").select("_row", F.coalesce("_last", "_carried").alias("_last"))
    joined = joined.unionByName(rows.where(~usable).select("_row"), allowMissingColumns=True)
    return joined.select("_row.*", *[F.col(f"_last.`{n}`").alias(n) for n in values])
