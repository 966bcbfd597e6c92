"""Ordered steps: how far each user got, every step on or after the day of the one before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def funnel(steps: Sequence[DataFrame], user: str, day: str = "day") -> DataFrame:
    """(`user`, days) of every user with the first step; `days` has the day of each step reached.

    `steps` are tables of (`user`, `day`) in the order of the steps. A step counts at its first day that
    is not before the step before it; on one day steps follow their order. Rows without a user or day
    are left out. Days are made distinct map-side, so that a user's list has at most one entry for each
    day and step, however many rows the user has; one pass over the sorted list matches all steps.
    """
    rows = None
    for n, step in enumerate(steps, start=1):
        found = step.select(user, F.col(day).cast("date").alias("_day"), F.lit(n).alias("_step"))
        rows = found if rows is None else rows.unionByName(found)
    distinct = rows.where(F.col(user).isNotNull() & F.col("_day").isNotNull()).distinct()
    listed = distinct.groupBy(user).agg(F.sort_array(F.collect_list(F.struct("_day", "_step"))).alias("_rows"))
    reached = "aggregate(_rows, CAST(array() AS ARRAY<DATE>), (done, r) -> IF(r._step = size(done) + 1, concat(done, array(r._day)), done))"
    return listed.select(user, F.expr(reached).alias("days")).where(F.size("days") > 0)


def quantiles(df: DataFrame, groups: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row for each group with exact quantiles of a whole-numbered `value` (null is left out).

    The quantile of a share is the smallest value that at least this share of the rows does not
    exceed. Rows are counted by value first; the lists that are summed up have one entry for each value.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*groups)
    running = counts.withColumns(
        {
            "_upto": F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_all": F.sum("_n").over(group),
        }
    )
    picks = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(share)), F.col(value))).alias(n) for n, share in shares.items()]
    return running.groupBy(*groups).agg(*picks)
