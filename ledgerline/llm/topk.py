"""Exact search by inner product: tiled matrix products, partial selection, merging of top lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

#: Rows of a shard, queries of a tile, and how many of each one task multiplies at most.
SHARD, TILE, SHARDS, TILES = 4096, 2048, 16, 64
LEAST = -(2**63)


def _shards(vectors: DataFrame, scale: float) -> DataFrame:
    """Vectors with an id and finite components only, as integer matrices sorted by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}

        def out(dim: int, rows: list) -> pa.RecordBatch:
            nonlocal made
            ids, asks, values = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.argsort(ids, kind="stable")
            most = float(np.abs(values).max(initial=0))
            kind = np.int16 if most < 2**15 else np.int64
            matrix = np.clip(values[order], -(2.0**62), 2.0**62).astype(kind)
            made += 1
            row = [task + made, dim, len(ids), min(most, 2.0**62), ids[order].tobytes(), asks[order].tobytes(), matrix.tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(["shard", "dim", "n", "most", "ids", "asks", "matrix"], row, strict=True))], schema=schema)

        for b in batches:
            column = b.column("v")
            dims = pa.compute.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
            ids = b.column("id").to_numpy(zero_copy_only=False)
            asks = b.column("asks").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            for dim in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == dim)
                flat = pa.compute.list_flatten(column.take(pa.array(at))).to_numpy(zero_copy_only=False)
                rows = np.asarray(flat, dtype=np.float64).reshape(-1, dim)
                fine = np.isfinite(rows).all(axis=1)
                rows = np.floor(scale * rows[fine])
                held.setdefault(int(dim), []).append((ids[at][fine].astype(np.int64), asks[at][fine], rows))
                if sum(len(x[0]) for x in held[dim]) >= SHARD:
                    ids_, asks_, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
                    for i in range(0, len(ids_) - SHARD + 1, SHARD):
                        yield out(int(dim), [(ids_[i : i + SHARD], asks_[i : i + SHARD], values[i : i + SHARD])])
                    if rest := len(ids_) % SHARD:
                        held[int(dim)] = [(ids_[-rest:], asks_[-rest:], values[-rest:])]
        for dim, rows in held.items():
            if sum(len(x[0]) for x in rows):
                yield out(dim, rows)

    schema = pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("n", pa.int64()), ("most", pa.float64()), *[(c, pa.binary()) for c in ("ids", "asks", "matrix")]])
    return vectors.mapInArrow(run, "shard long, dim int, n long, most double, ids binary, asks binary, matrix binary")


def _values(data: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * n * dim else np.int64
    return np.frombuffer(data, kind).reshape(n, dim)


def _tiles(shards: DataFrame) -> DataFrame:
    """Queries of all shards, each with the place of its own row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        task, made = TaskContext.get().partitionId() << 32, 0

        def out(dim: int, rows: list) -> pa.RecordBatch:
            nonlocal made
            made += 1
            ids, shard, place, values = (np.concatenate(x) for x in zip(*rows, strict=True))
            most = float(np.abs(values.astype(np.float64)).max(initial=0))
            matrix = values.astype(np.int16 if most < 2**15 else np.int64)
            row = [task + made, dim, len(ids), most, ids.tobytes(), shard.tobytes(), place.tobytes(), matrix.tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=schema)

        for b in batches:
            for r in b.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["asks"], bool))
                if not len(at):
                    continue
                values = _values(r["matrix"], r["n"], r["dim"])[at].astype(np.int64)
                ids = np.frombuffer(r["ids"], np.int64)[at]
                parts = held.setdefault(r["dim"], [])
                parts.append((ids, np.full(len(at), r["shard"]), at.astype(np.int64), values))
                if sum(len(p[0]) for p in parts) > TILE:
                    whole = [np.concatenate(x) for x in zip(*held.pop(r["dim"]), strict=True)]
                    for i in range(0, len(whole[0]), TILE):
                        yield out(r["dim"], [tuple(x[i : i + TILE] for x in whole)])
        for dim, parts in held.items():
            yield out(dim, parts)

    names = ["tile", "dim", "n", "most", "ids", "shards", "places", "matrix"]
    schema = pa.schema([("tile", pa.int64()), ("dim", pa.int32()), ("n", pa.int64()), ("most", pa.float64()), *[(c, pa.binary()) for c in names[4:]]])
    return shards.mapInArrow(run, "tile long, dim int, n long, most double, ids binary, shards binary, places binary, matrix binary")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by score, then smaller id."""
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]  # ~x falls as x grows, without overflow
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _best_of_shard(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one shard, whose ids ascend: a partial selection by score and place, then a sort."""
    n = scores.shape[1]
    if n > k:
        if np.abs(np.maximum(scores, LEAST + 1)[scores > LEAST]).max(initial=0) < 2**50:
            ranked = np.where(scores == LEAST, -(2**62), scores * SHARD) - np.arange(n)
            keep = np.argpartition(ranked, n - k, axis=1)[:, n - k :]
        else:
            keep = np.argsort(~scores, axis=1, kind="stable")[:, :k]
        return _best(np.take_along_axis(scores, keep, 1), ids[keep], k)
    return _best(scores, np.broadcast_to(ids, scores.shape), k)


def _products(q: np.ndarray, c: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products as long numbers; beyond that range they stop at its ends."""
    if most * q.shape[1] < 2**52:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, LEAST + 1, 2**63 - 1).astype(np.int64)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best partners of every row that `is_query` selects.

    Components count as floor(scale * x). Partners are all other rows, ties go to the smaller id.
    Rows whose id or vector is null, or whose vector is empty or holds a null or non-finite
    component, take no part; only vectors of the same length meet. Rows that repeat an id are
    vectors of their own: each may be found, and each is a query. Scores beyond a long stop there.

    Shards of rows and tiles of queries meet in groups, so that a task holds a bounded number of
    both; a product is cut into slices, each slice keeps its best k, and lists are merged per task
    and then over tasks.
    """
    component = F.col(f"`{vector_column}`").cast("array<double>")
    given = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), component.alias("v"), is_query.alias("asks"))
    given = given.where("id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    shards = staged(_shards(given, scale), "shards")
    tiles = staged(_tiles(shards.select("shard", "dim", "n", "ids", "asks", "matrix")), "tiles")
    by_shard, by_tile = (-(-df.count() // most) or 1 for df, most in ((shards, SHARDS), (tiles, TILES)))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(by_tile - 1).cast("long")))
    left = shards.select(F.pmod(F.xxhash64("shard"), F.lit(by_shard)).alias("g"), spread.alias("h"), "dim", "shard", "n", "most", F.col("ids"), "matrix")
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(by_shard - 1).cast("long")))
    right = tiles.select(spread.alias("g"), F.pmod(F.xxhash64("tile"), F.lit(by_tile)).alias("h"), "dim", "tile", F.col("n").alias("qn"), F.col("most").alias("qmost"), F.col("ids").alias("qids"), "shards", "places", F.col("matrix").alias("qmatrix"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, list] = {}
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                q, c = _values(r["qmatrix"], r["qn"], r["dim"]), _values(r["matrix"], r["n"], r["dim"])
                ids = np.frombuffer(r["ids"], np.int64)
                own = np.where(np.frombuffer(r["shards"], np.int64) == r["shard"], np.frombuffer(r["places"], np.int64), -1)
                found = []
                for s in range(0, len(q), 256):
                    scores = _products(q[s : s + 256], c, r["most"] * r["qmost"])
                    at = np.flatnonzero(own[s : s + 256] >= 0)
                    scores[at, own[s : s + 256][at]] = LEAST
                    found.append(_best_of_shard(scores, ids, k))
                scores, ids = (np.concatenate(x) for x in zip(*found, strict=True))
                if r["tile"] in lists:
                    old = lists[r["tile"]]
                    scores, ids = _best(np.hstack([old[0], scores]), np.hstack([old[1], ids]), k)
                    lists[r["tile"]] = [scores, ids, *old[2:]]
                else:
                    lists[r["tile"]] = [scores, ids, *(np.frombuffer(r[x], np.int64) for x in ("qids", "shards", "places"))]
        for scores, ids, *query in lists.values():
            real = scores > LEAST
            each = real.sum(axis=1)
            yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(x, each)) for x in query), pa.array(ids[real]), pa.array(scores[real])], names=["query_id", "shard", "place", "vec_id", "score"])

    met = left.join(right, ["g", "h", "dim"])
    found = met.mapInArrow(run, "query_id long, shard long, place long, vec_id long, score long")
    order = Window.partitionBy("query_id", "shard", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
