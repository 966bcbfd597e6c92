"""Tables that remember: merges whose rule is an aggregate, and versions of rows with their validity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import asof_last

VALIDITY = ["valid_from", "valid_to"]


def merged_by(
    held: DataFrame, batch: DataFrame, keys: Sequence[str], rules: Mapping[str, Callable[[str], Column]]
) -> DataFrame:
    """One row for each key of both tables; `rules` names the aggregate that decides each column.

    With aggregates such as `min` and `max`, for which order and repetition do not matter, batches may
    come late, twice, or in any order: the rows are the same. Nulls never win over values. Both sides
    are aggregated map-side before they meet.
    """
    both = held.select(*keys, *rules).unionByName(batch.select(*keys, *rules))
    return both.groupBy(*keys).agg(*[rule(c).alias(c) for c, rule in rules.items()])


def _digest(columns: Sequence[str], side: str = "") -> Column:
    """Digest of a row's values, null apart from any text."""
    values = [F.col(f"{side}`{c}`").cast("string") for c in columns]
    framed = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*framed), 256)


def with_versions(history: DataFrame | None, batch: DataFrame, key: str, tracked: Sequence[str], at: Column) -> DataFrame:
    """The whole history after a batch that was true from `at`: (`key`, `tracked`, valid_from, valid_to).

    A version holds from `valid_from` until before `valid_to`; the open one has no end. A key whose digest
    of tracked values changed gets its open version closed and a new one, a new key its first one;
    an equal row changes nothing, so a batch may be loaded again. A batch of the same moment as the open
    version corrects it in place. Where the open version is younger than the batch, or the key is missing
    from the batch, the history stays as it is. The batch holds each key once; rows without a key are
    left out. Closed versions are not compared with anything.
    """
    new = batch.where(F.col(key).isNotNull()).select(key, *tracked, at.cast("timestamp_ntz").alias("valid_from"))
    if history is None:
        return new.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    open_ = history.where("valid_to IS NULL").alias("o")
    met = open_.join(new.alias("n"), F.col(f"o.`{key}`") == F.col(f"n.`{key}`"), "full")
    old_from, new_from = F.col("o.valid_from"), F.col("n.valid_from")
    differs = F.coalesce(_digest(tracked, "o.") != _digest(tracked, "n."), F.lit(False)) & old_from.isNotNull() & new_from.isNotNull()

    def version(side: str, begin: Column, end: Column) -> Column:
        fields = [F.col(f"{side}`{c}`").alias(c) for c in (key, *tracked)]
        return F.struct(*fields, begin.alias("valid_from"), end.cast("timestamp_ntz").alias("valid_to"))

    never = F.lit(None)
    rows = (
        F.when(old_from.isNull(), F.array(version("n.", new_from, never)))
        .when(differs & (new_from > old_from), F.array(version("o.", old_from, new_from), version("n.", new_from, never)))
        .when(differs & (new_from == old_from), F.array(version("n.", new_from, never)))
        .otherwise(F.array(version("o.", old_from, never)))
    )
    current = met.select(F.explode(rows).alias("v")).select("v.*")
    return history.where("valid_to IS NOT NULL").select(key, *tracked, *VALIDITY).unionByName(current)


def as_of(rows: DataFrame, history: DataFrame, key: str, time: str, values: Mapping[str, str]) -> DataFrame:
    """`rows` plus `values` of the version of their `key` that held at `time`; null where none did.

    Versions do not overlap, so the one that began last before is the only one that may hold: an as-of
    join, and no join over ranges.
    """
    end = "_ends"
    found = asof_last(rows, history, key, time, "valid_from", "valid_from", {**values, end: "valid_to"})
    holds = F.col(end).isNull() | (F.col(end) > F.col(time))
    return found.select(*rows.columns, *[F.when(holds, F.col(v)).alias(v) for v in values])
