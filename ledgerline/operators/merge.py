"""Set operations between what a table holds and what a batch brings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .lookup import fits_broadcast

#: Rows of a batch up to which its keys may be broadcast, about 140 bytes each. Spark's own estimate
#: follows the bytes of the files, in which dense keys take almost none.
BROADCAST_ROWS = 100_000


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """`df` in the declared columns, order and types; columns it lacks are null."""
    present = set(df.columns)

    def column(name: str, kind: str) -> str:
        return f"CAST({f'`{name}`' if name in present else 'NULL'} AS {kind}) AS `{name}`"

    return df.selectExpr(*[column(f.name, f.dataType.simpleString()) for f in schema.fields])


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _many(rows: int | None) -> bool:
    """Whether a batch of so many rows is too large to broadcast; None if that is not known."""
    return rows is not None and rows > BROADCAST_ROWS


def rows_in(target: DataFrame, batch: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Rows of `target` whose key `batch` holds; null counts as a key value.

    `rows` is the size of the batch, where it is known: many rows are not broadcast.
    """
    asked = batch.select(*keys)
    asked = asked.hint("merge") if _many(rows) else asked
    return target.alias("held").join(asked.alias("asked"), _met("held", "asked", keys), "left_semi")


def _met(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of the keys of two aliased sides, null equal to null."""
    pairs = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def rows_not_in(target: DataFrame, batch: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Rows of `batch` whose key `target` does not hold yet; null counts as a key value.

    If the keys of the batch are small enough to broadcast, the target's keys are first cut down
    to those the batch mentions: a large target is then scanned for its key and never shuffled.
    `rows` is the size of the batch, where it is known: for many rows neither side is broadcast.
    """
    held = target.select(*keys).alias("held")
    if _many(rows):
        held = target.select(*keys).hint("merge").alias("held")
    elif fits_broadcast(batch.select(*keys)):
        asked = batch.select(*keys).distinct().alias("asked")
        held = held.join(asked, _same(held, asked, keys), "left_semi").distinct().alias("seen")
    return batch.join(held, _same(batch, held, keys), "left_anti")


#: Columns that say when a row arrived; of several stored copies the earliest is kept.
ARRIVAL = ("ingested_at", "loaded_at")


def _arrival_first(kept: Sequence[str]) -> list[str]:
    return [c for c in ARRIVAL if c in kept] + [c for c in kept if c not in ARRIVAL]


def _upserted_at_once(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], kept: Sequence[str]
) -> DataFrame:
    """`upserted` by one shuffle and sort of both sides: stored copies of a key come first, the one
    that arrived first at their head, then the row of the batch."""
    both = target.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
    order = [F.col(f"`{c}`").asc_nulls_first() for c in _arrival_first(kept)]
    copies = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy("_new", *order)
    copies = copies.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    asked, held = F.max("_new").over(copies), ~F.first("_new").over(copies)
    heads = {f"_old_{c}": F.first(f"`{c}`").over(copies) for c in kept}
    seen = both.withColumns({"_asked": asked, "_held": held, **heads}).where("_new OR NOT _asked")
    before = F.col("_new") & F.col("_held")
    return seen.select(
        *[
            F.when(before, F.col(f"`_old_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in kept else F.col(f"`{c}`")
            for c in target.columns
        ]
    )


def upserted(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    rows: int | None = None,
) -> DataFrame:
    """`target` after inserting the batch, or updating `update_columns` where the key exists.

    Both sides share one schema and the batch holds a key once; null counts as a key value. Rows
    whose key the batch does not have stay as they are, repeated ones too. A key of the batch ends
    up once: if the target holds it, all columns that are not updated keep the value of the stored
    copy that arrived first, or of the smallest of copies that arrived together.

    The rows are the same whatever the sizes; Spark picks the joins by what it knows of them. If `rows`,
    the size of the batch, says that these are many, stored and new rows meet in one shuffle instead.
    """
    kept = [c for c in target.columns if c not in keys and c not in update_columns]
    if _many(rows):
        return _upserted_at_once(target, batch, keys, kept)
    asked = batch.select(*keys).alias("asked")
    stored = target.alias("stored")
    same = _met("stored", "asked", keys)
    untouched = stored.join(asked, same, "left_anti").select(*[F.col(f"`{c}`") for c in target.columns])
    order = _arrival_first(kept)
    copies = stored.join(asked, same, "left_semi").groupBy(*[F.col(f"`{k}`") for k in keys])
    before = copies.agg(F.min(F.struct(F.lit(True).alias("_held"), *[F.col(f"`{c}`") for c in order])).alias("_old"))
    new, old = batch.alias("new"), before.alias("old")
    merged = new.join(old, _met("new", "old", keys), "left").select(
        *[
            F.when(F.col("old._old").isNotNull(), F.col(f"old._old.`{c}`")).otherwise(F.col(f"new.`{c}`")).alias(c)
            if c in kept
            else F.col(f"new.`{c}`").alias(c)
            for c in target.columns
        ]
    )
    return untouched.unionByName(merged)
