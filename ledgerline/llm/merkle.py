"""Merkle manifest of a table: a digest for each row, a tree for each group of rows, one root.

Rows of a tree are numbered in order and dealt out in aligned blocks of 2^`BITS`. A block keeps each
of its levels as one string of digests of fixed width: parents are digests of substrings, and the
substrings beside a node in its run are its siblings on that level. The roots of the blocks are rows of
the next, much smaller tree, so that a level never has to be in one place. Going back down, the siblings
above a block are put behind those within it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import staged

#: Levels within a block of at most 2^BITS nodes.
BITS = 8
#: Hex digits of a digest.
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*values: Column) -> Column:
    """Digest of values, each framed by its length in bytes so that no two rows look alike."""
    texts = [v.cast("string") for v in values]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """`nodes` with `_pos`, their number in their `_tree` by `order`, and `_total`, how many it has.

    Nodes are cut into ranges and counted by range; `order` must tell all nodes of a tree apart.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, "_tree", *order).sortWithinPartitions("_tree", *order)
    ranged = staged(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "merkle-order")
    tree = Window.partitionBy("_tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ranged.groupBy("_tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    runs = runs.select(
        "_tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("_total")
    )
    return ranged.join(runs, ["_tree", "_part"]).withColumn("_pos", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def blocks(nodes: DataFrame) -> DataFrame:
    """Nodes by aligned block, with the strings of the block's levels; the last one is its root."""
    carried = [c for c in nodes.columns if c not in ("_tree", "_total")]
    grouped = nodes.groupBy("_tree", "_total", F.shiftright("_pos", BITS).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", *[c for c in carried if c != "_pos"]))).alias("_nodes")
    )
    parents = f"""transform(sequence(0L, (length(element_at(up, -1)) - 1) div {2 * WIDTH}),
        i -> sha2(substring(element_at(up, -1), CAST(i * {2 * WIDTH} + 1 AS INT), {2 * WIDTH}), 256))"""
    levels = f"""aggregate(
        slice(sequence(1, {BITS}), 1, IF(_total > {1 << BITS}, {BITS}, IF(_total > 1, length(bin(_total - 1)), 0))),
        array(CAST(array_join(transform(_nodes, x -> x._digest), '') AS BINARY)),
        (up, level) -> concat(up, array(CAST(array_join({parents}, '') AS BINARY))))"""
    return grouped.withColumn("_levels", F.expr(levels))


def grown(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, then of the roots of these blocks, and so on to one block for each tree."""
    most = nodes.agg(F.max("_total")).first()[0] or 0
    built = [staged(blocks(nodes), "merkle-blocks")]
    while most > 1 << BITS:
        roots = built[-1].select(
            "_tree",
            F.shiftright(F.col("_total") + ((1 << BITS) - 1), BITS).alias("_total"),
            F.col("_block").alias("_pos"),
            root().alias("_digest"),
        )
        built.append(staged(blocks(roots), "merkle-blocks"))
        most = -(-most >> BITS)
    return built


def root() -> Column:
    return F.element_at("_levels", -1).cast("string")


def descended(built: list[DataFrame], above: DataFrame) -> DataFrame:
    """Nodes with `_siblings` up to the end of the path `_above` of their tree's last block."""
    node = f"shiftright(CAST(x._pos & {(1 << BITS) - 1} AS INT), l)"
    siblings = f"""concat(transform(slice(_levels, 1, size(_levels) - 1), (level, l) -> named_struct(
        'left', CAST(substring(level, ({node} - ({node} & 1)) * {WIDTH} + 1, ({node} & 1) * {WIDTH}) AS STRING),
        'right', CAST(substring(level, ({node} + 1) * {WIDTH} + 1, (1 - ({node} & 1)) * {WIDTH}) AS STRING))), _above)"""
    for held in reversed(built):
        fields = held.schema["_nodes"].dataType.elementType.names
        each = ", ".join(f"'{c}', x.`{c}`" for c in fields)
        nodes = held.join(above, ["_tree", "_block"]).select(
            "_tree", "_subroot", "_root", F.expr(f"inline(transform(_nodes, x -> named_struct({each}, '_siblings', {siblings})))")
        )
        above = nodes.select("_tree", F.col("_pos").alias("_block"), F.col("_siblings").alias("_above"), "_subroot", "_root")
    return nodes


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_column: str = "doc_id",
    tree_column: str = "lang",
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(`id_column`, leaf, subroot, root, siblings) of each row, and the columns `carried` names.

    `leaf` is the digest of `fields`. Rows with one value of `tree_column` (null is one) make a tree, in
    the order of ids, null first; of rows that share an id the smaller leaf comes first, and rows that
    repeat each have a place. While a level has several nodes, every two become their digest, a last one
    alone too. Subroots by `tree_column`, null first, make the upper tree. `siblings` lists, from the leaf
    up to the root, what stands left and right of the path (empty strings where nothing does).
    No rows give no rows. Columns that are not named are not looked at.
    """
    carried = {f"_carried_{k}": v for k, v in (carried or {}).items()}
    tree = F.col(f"`{tree_column}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), tree), F.lit("-")).alias("_tree"),
        F.col(f"`{id_column}`").alias("_id"),
        digest_of(*[F.col(f"`{c}`") for c in fields]).alias("_digest"),
        *[v.alias(k) for k, v in carried.items()],
        F.monotonically_increasing_id().alias("_n"),
    )
    nodes = placed(staged(leaves, "merkle-leaves"), "_id", "_digest", "_n").drop("_n")
    below = grown(nodes)

    subroots = below[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), root().alias("_digest"))
    upper = grown(placed(subroots, "_name"))
    no_path = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    top = upper[-1].select("_tree", "_block", no_path.alias("_above"), F.lit(None).cast("string").alias("_subroot"), root().alias("_root"))
    top = descended(upper, top).select(
        F.col("_name").alias("_tree"), F.lit(0).cast("long").alias("_block"), F.col("_siblings").alias("_above"), F.col("_digest").alias("_subroot"), "_root"
    )
    return descended(below, top).select(
        F.col("_id").alias(id_column),
        *[F.col(k).alias(k.removeprefix("_carried_")) for k in carried],
        F.col("_digest").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_siblings").alias("siblings"),
    )


def proof_text(siblings: str = "siblings") -> Column:
    """All siblings of a path, from the leaf to the root, left to right."""
    return F.expr(f"array_join(transform({siblings}, x -> x.left || x.right), '')")


def folded(leaf: str, siblings: str = "siblings") -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.expr(f"aggregate({siblings}, {leaf}, (node, x) -> sha2(x.left || node || x.right, 256))")
