"""Connected components of links held as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import forget, staged


def _jump(parent: DataFrame) -> DataFrame:
    """Every vertex's parent's parent."""
    up = parent.select(F.col("node").alias("_at"), F.col("parent").alias("_up"))
    return parent.join(up, F.col("parent") == F.col("_at"), "left").select(
        "node", F.coalesce("_up", "parent").alias("parent")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every vertex of `links` (a, b); comp is one vertex of its component.

    In each round every vertex points to its smallest neighbour, pointers are followed four deep,
    and links are redrawn between what they lead to. Vertices are fingerprints, hence in random
    order, so that pointers form shallow trees and the links shrink by a factor each round. Hot
    vertices are aggregated before they are shuffled.
    """
    links = staged(links.select("a", "b").where("a != b").distinct(), "links")
    names = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    label = names.distinct().select("node", F.col("node").alias("comp"))
    first, parents = links, []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        nearest = staged(near.select("node", F.least("node", "_b").alias("parent")), "parents")
        parent = staged(_jump(_jump(nearest)), "parents")
        forget(nearest)
        parents.append(parent)
        pa, pb = (parent.select(F.col("node").alias(k), F.col("parent").alias(f"p{k}")) for k in "ab")
        drawn = links.join(pa, "a").join(pb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        before, links = links, staged(drawn.where("a != b").distinct(), "links")
        if before is not first:
            forget(before)
        moved = parent.select(F.col("node").alias("comp"), "parent")
        label = label.join(moved, "comp", "left").select("node", F.coalesce("parent", "comp").alias("comp"))
    out = staged(label, "components")
    forget(first, links, *parents)
    return out
