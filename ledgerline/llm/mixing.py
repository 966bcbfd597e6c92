"""Mixing sources to target weights by thresholds on a hash.

Every document has a hash that depends on its id alone. A source takes each of its documents a whole
number of times, and once more those whose hash lies below a threshold. The threshold is found
without sorting: sizes are summed by source and leading bits of the hash, the bucket in which the
budget ends is found, and only its documents are summed again by the next bits. Sums are formed
before the shuffle, so that a source with a third of all documents is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import with_dense_keys
from .rules import words
from .tables import count_up_to, staged

#: A hash has 60 bits; each step refines by these bits, the boundary bucket of the last is one hash.
BITS, STEPS = 60, (12, 16, 16, 16)
#: Source tables of at most so many rows are broadcast; others meet documents in a salted join.
BROADCAST_SOURCES, SALTS = 100_000, 64
#: No source is taken more than this many times its size.
MOST = 3


def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """`rows` joined with their source's row; `source_key` stands for the source, null included."""
    if count_up_to(sources, BROADCAST_SOURCES) <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(sources), "source_key")
    salted = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.col("h"), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, ["source_key", "_salt"]).drop("_salt")


def targets(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """`sources` (source_key, source, source_size) with `target`.

    Sources in code point order, null last, take the weights in turn. They share the sum of all
    sizes by weight; what a source would get beyond MOST times its size is shared again.
    """
    first = sources.where("source IS NOT NULL")
    dense = with_dense_keys(first, "source", "_place").select("source_key", "_place")
    count = dense.count()
    placed = sources.join(dense, "source_key", "left")
    turn = F.coalesce(F.col("_place") - 1, F.lit(count)) % len(weights) + 1
    placed = placed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int"))).drop("_place")
    placed = staged(placed.withColumn("limit", F.col("source_size") * MOST), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        full = F.col("limit") <= F.lit(share) * F.col("weight")
        row = placed.agg(
            F.sum(F.when(full, F.col("limit"))).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        again = (total - (row.fixed or 0)) / row.open if row.open else share
        if again <= share:
            break
        share = again
    return placed.withColumn("target", F.least(F.lit(share) * F.col("weight"), F.col("limit").cast("double"))).drop("limit")


def _keyed(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """`docs` with `source_key` (null included), `size` in words and hash `h`."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
    return docs.withColumns(
        {
            "source_key": F.coalesce(F.concat(F.lit("="), F.col(f"`{source_column}`").cast("string")), F.lit("null")),
            "size": F.size(words(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))).cast("long"),
            "h": h.cast("long"),
        }
    )


def plan_mix(sized: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(source_key, source_size, target, times, threshold) of each source of `sized` (source_key, size, h)."""
    sources = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    source = F.when(F.col("source_key") != "null", F.substring("source_key", 2, 2**30))
    sources = targets(staged(sources.withColumn("source", source), "sources"), weights)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(0).cast("long")
    sources = sources.withColumn("times", whole)
    sources = sources.withColumn("budget", F.col("target") - F.col("times") * F.col("source_size"))
    marks = _thresholds(sized.where("size > 0").select("source_key", "h", "size"), sources.select("source_key", "budget"))
    planned = sources.join(marks, "source_key", "left")
    return staged(planned.select("source_key", "source_size", "target", "times", F.coalesce("threshold", F.lit(0)).alias("threshold")), "mix")


def _times() -> Column:
    return F.col("times") + (F.col("h") < F.col("threshold")).cast("long")


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1),
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row of `docs`.

    `size` is the number of words (null text: 0), `taken` the words that the mix takes of the row,
    repeats counted: 0 to MOST times its size. Rows with the same id and source share a hash and are
    treated alike. A threshold is set where a source's words come nearest to its target; sums that
    are equally near take the smaller. A null source is a source of its own. Other columns are
    ignored. Reruns give the same rows: nothing is random.
    """
    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.col(f"`{source_column}`").alias("source"))
    sized = staged(_keyed(given, "doc_id", "text", "source").drop("text", "source"), "sized")
    joined = with_sources(sized, plan_mix(sized, weights))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * _times()).alias("taken"))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1),
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes it, with their own columns.

    Rows without words are never taken. Texts are not shuffled.
    """
    columns = docs.columns
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"), F.col(f"`{source_column}`").alias("source"),
    )
    keyed = _keyed(given, "doc_id", "text", "source").drop("text", "source")
    plan = plan_mix(staged(keyed.select("source_key", "size", "h"), "sized"), weights)
    times = F.when(F.col("size") > 0, _times()).otherwise(0)
    taken = with_sources(keyed, plan).withColumn("_n", times).where("_n > 0")
    taken = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return taken.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source_key, threshold): rows with a smaller hash together come nearest to the budget."""
    state = budgets.select("source_key", "budget", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("below"))
    left = BITS
    order = Window.partitionBy("source_key").orderBy("bucket")
    for step, bits in enumerate(STEPS):
        inside = with_sources(sized, state)
        if step:  # only the boundary bucket of the step before
            inside = inside.where(F.shiftright("h", left) == F.shiftright("begin", left))
        left -= bits
        sums = inside.groupBy("source_key", F.shiftright("h", left).alias("bucket"), "budget", "below").agg(F.sum("size").alias("size"))
        upto = F.col("below") + F.sum("size").over(order)
        cut = sums.withColumn("_upto", upto).where("_upto > budget")  # the first of these is the boundary
        first = cut.groupBy("source_key").agg(F.min(F.struct("bucket", "_upto", "size")).alias("_c"))
        found = first.select("source_key", F.shiftleft("_c.bucket", left).alias("_begin"), (F.col("_c._upto") - F.col("_c.size")).alias("_below"), F.col("_c._upto").alias("_next"))
        state = budgets.join(found, "source_key").select("source_key", "budget", F.col("_begin").alias("begin"), F.col("_below").alias("below"), F.col("_next").alias("next"))
        state = staged(state, "boundaries")
        if left:
            state = state.drop("next")
    nearer = F.col("next") - F.col("budget") < F.col("budget") - F.col("below")
    found = state.select("source_key", (F.col("begin") + nearer.cast("long")).alias("threshold"))
    # A source whose sizes never exceed its budget has no boundary; that is a budget of its whole size.
    return found
