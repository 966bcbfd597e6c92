"""Prefix trie of conversations: who shares which beginning, and how many tokens that saves.

Conversations are sorted by the digests of their turns and cut into shards. A shard writes its trie as
balanced parentheses, a pair for each node. The end of a subtree is found by the excess of opening
over closing ones in blocks with known minima; counts of pairs with nothing between and running sums up to
it give what a subtree holds. Beginnings that two neighbouring shards share are nodes of both: these
spines are put together by the digest of their path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import staged

#: Bytes of a turn's digest.
WIDTH = 16
#: Turns and conversations of a shard, at most about this many and, while there are few, at least.
MOST, LEAST = 1 << 18, 1 << 12
#: Ids of one row, where a list of ids goes on in another shard.
CHUNK = 1 << 13
NOTHING = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses as bits (1 opens), with minima of the excess by block."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.opened = np.concatenate([[0], np.cumsum(bits)])
        excess = np.cumsum(np.where(bits, 1, -1).astype(np.int32), dtype=np.int32)
        blocks = 1 << max(0, int(-(-len(bits) // self.BLOCK) - 1).bit_length())
        self.excess = np.full((blocks, self.BLOCK), np.iinfo(np.int32).max, dtype=np.int32)
        self.excess.reshape(-1)[: len(bits)] = excess
        #: A heap: `least[n]` is the smallest excess below node n, blocks are the last half.
        self.least = np.concatenate([np.zeros(blocks, np.int32), self.excess.min(axis=1)])
        for n in range(blocks.bit_length() - 1, 0, -1):
            low = 1 << (n - 1)
            self.least[low : 2 * low] = self.least[2 * low : 4 * low].reshape(-1, 2).min(axis=1)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many open before `at`."""
        return self.opened[at]

    def find_close(self, at: np.ndarray, step: int = 1 << 14) -> np.ndarray:
        """Where the pairs that open at `at` close: the next place with a smaller excess."""
        return np.concatenate([np.zeros(0, np.int64), *(self._close(at[i : i + step]) for i in range(0, len(at), step))])

    def _close(self, at: np.ndarray) -> np.ndarray:
        block, place = np.divmod(at, self.BLOCK)
        aim = self.excess[block, place] - 1
        found = (self.excess[block] <= aim[:, None]) & (np.arange(self.BLOCK) > place[:, None])
        out = at - place + found.argmax(axis=1)
        far = np.flatnonzero(~found.any(axis=1))
        if not len(far):
            return out
        blocks, aim = len(self.excess), aim[far]
        node = block[far] + blocks
        left = np.arange(len(far))  # those whose block is not found yet: on to the next subtree to the right
        while len(left):
            n = node[left] + 1
            while (odd := (n & 1 == 0) & (self.least[n] > aim[left])).any():
                n = np.where(odd, n >> 1, n)
            node[left] = n
            left = left[self.least[n] > aim[left]]
        while (low := node < blocks).any():
            down = 2 * node[low]
            node[low] = down + (self.least[down] > aim[low])
        block = node - blocks
        out[far] = block * self.BLOCK + (self.excess[block] <= aim[:, None]).argmax(axis=1)
        return out


class Minima:
    """Smallest values of ranges, from ranges of every power of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            half, last = 1 << (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        power = np.frexp((end - begin).astype(np.float64))[1] - 1
        out = np.empty(len(begin), dtype=self.rows[0].dtype)
        for p in np.unique(power):
            some = power == p
            out[some] = np.minimum(self.rows[p][begin[some]], self.rows[p][end[some] - (1 << p)])
        return out


def shared_turns(x: bytes, y: bytes) -> int:
    """How many turns two sequences begin with alike."""
    low, high = 0, min(len(x), len(y)) // WIDTH
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if x[low * WIDTH : half * WIDTH] == y[low * WIDTH : half * WIDTH] else (low, half - 1)
    return low


def paths(key: bytes, depth: int) -> list[bytes]:
    """Digests of the paths to depth 0, 1, ... `depth` of a sequence."""
    h, out = hashlib.blake2b(digest_size=WIDTH), []
    for d in range(depth + 1):
        out.append(h.digest())
        h.update(key[d * WIDTH : (d + 1) * WIDTH])
    return out


NODES = "shard long, path binary, parent_path binary, chunk long, ids string, conv_id long, depth long, parent_conv_id long, "
NODES += "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string(), *[pa.int64()] * 7, pa.string()]
NAMES = [c.split()[0] for c in NODES.split(", ")]


def shard_nodes(shard: int, keys: list[bytes], convs: np.ndarray, sizes: np.ndarray, before: bytes | None, after: bytes | None) -> pa.Table:
    """Nodes of sorted sequences. `sizes` are the code points of all their turns, one after another;
    `before` and `after` are the sequences next to the shard, None where there are none.

    Nodes on a path that a neighbour shares have a `path`; their numbers hold what this shard adds:
    a child or a node's own text counts in the first shard that has it, a leaf in the last.
    Ids that end at such a node follow as rows with a `chunk`.
    """
    length = np.array([len(k) // WIDTH for k in keys])
    alike = np.array([0, *(shared_turns(x, y) for x, y in zip(keys, keys[1:], strict=False))])
    opens, closes = length - alike, np.concatenate([[0], length[:-1] - alike[1:]])
    runs = np.concatenate([[0, 1], np.stack([closes, opens], axis=1).reshape(-1), [length[-1] + 1]])
    pairs = Parentheses(np.repeat(np.arange(len(runs)) % 2 == 1, runs))

    n = 1 + int(opens.sum())
    owner = np.repeat(np.arange(len(keys)), opens)
    nth = np.arange(n - 1) - np.repeat(np.cumsum(opens) - opens, opens) + alike[owner]
    depth = np.concatenate([[0], nth + 1])
    size = np.concatenate([[0], sizes[(np.cumsum(length) - length)[owner] + nth]]).astype(np.int64)
    by_level = depth * n + np.arange(n)
    levels = np.sort(by_level)
    parent = levels[np.searchsorted(levels, by_level - n) - 1] % n
    parent[0] = -1
    end = np.cumsum(opens)  # the node of each whole sequence

    # Which nodes neighbours share: the first ones, and the last one of each depth.
    left = -1 if before is None else shared_turns(before, keys[0])
    right = -1 if after is None else shared_turns(keys[-1], after)
    last_path = levels[np.searchsorted(levels, (np.arange(right + 1) + 1) * n) - 1] % n
    path = np.full(n, None, dtype=object)
    path[: left + 1] = paths(keys[0], left) if left >= 0 else []
    path[last_path] = paths(keys[-1], right) if right >= 0 else []
    spine = np.array([p is not None for p in path])

    at = np.flatnonzero(pairs.bits)
    close = pairs.find_close(at)
    this, beyond = np.arange(n), pairs.rank(close)
    ended = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=n))])
    members = ended[beyond] - ended[this]
    smallest = np.full(n, np.iinfo(np.int64).max)
    first = np.flatnonzero(np.diff(end, prepend=-1))
    smallest[end[first]] = convs[first]
    smallest = Minima(smallest).of(this, beyond)

    leaf = pairs.bits & ~np.append(pairs.bits[1:], False)
    if right == length[-1]:
        leaf[at[end[-1]]] = False  # goes on, or ends again, in a later shard
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    fresh = np.arange(n) > left
    children = np.bincount(parent[1:], weights=fresh[1:], minlength=n).astype(np.int64)
    saved = np.concatenate([[0], np.cumsum(members * size - fresh * size)])

    hashes = np.full(n, NOTHING, dtype=object)
    more = []
    for begin, stop in zip(first, [*first[1:], len(end)], strict=True):
        node = end[begin]
        if spine[node]:
            for k, some in enumerate(range(begin, stop, CHUNK)):
                more.append((path[node], k, ",".join(map(str, convs[some : min(some + CHUNK, stop)].tolist()))))
        else:
            hashes[node] = hashlib.sha256(",".join(map(str, convs[begin:stop].tolist())).encode()).hexdigest()
    hashes[spine] = None
    known_parent = (parent >= 0) & ~spine[parent]
    columns = [
        pa.array(np.full(n, shard)),
        pa.array(path, pa.binary()),
        pa.array([path[p] if p >= 0 else None for p in parent], pa.binary()),
        pa.nulls(n, pa.int64()),
        pa.nulls(n, pa.string()),
        pa.array(smallest),
        pa.array(depth),
        pa.array(smallest[parent], mask=~known_parent),
        pa.array(members),
        pa.array(children),
        pa.array(leaves[close] - leaves[at]),
        pa.array(saved[beyond] - saved[this]),
        pa.array(hashes, pa.string()),
    ]
    found = pa.Table.from_arrays([c.cast(t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES)
    rows = [{"shard": shard, "path": p, "chunk": k, "ids": ids} for p, k, ids in more]
    return pa.concat_tables([found, pa.Table.from_pylist(rows, schema=found.schema)])


def sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each shard in a stream sorted by shard, place and sequence."""
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        place = rows.column("place").to_numpy()
        keys, own = rows.column("key").to_pylist(), np.flatnonzero(place == 1)
        sizes = rows.column("sizes").take(pa.array(own)).combine_chunks().flatten().to_numpy()
        near = {p: k for p, k in zip(place.tolist(), keys, strict=True) if p != 1}
        convs = rows.column("conv_id").take(pa.array(own)).to_numpy()
        found = shard_nodes(rows.column("shard")[0].as_py(), [keys[i] for i in own], convs, sizes, near.get(0), near.get(2))
        yield from found.to_batches(max_chunksize=20_000)

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin == end:
                continue
            if held and held[-1].column("shard")[0].as_py() != shards[begin]:
                yield from flush()
            held.append(batch.slice(begin, end - begin))
    if held:
        yield from flush()


def whole_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each path in a stream sorted by path and place; holds no list of ids."""
    path, h = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": pa.array([path], pa.binary()), "ends_sha256": [h.hexdigest()]})

    for batch in batches:
        for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if p != path:
                if h:
                    yield row()
                path, h = p, hashlib.sha256()
                h.update(ids.encode())
            else:
                h.update(b"," + ids.encode())
    if h:
        yield row()


def sequences(conversations: DataFrame, stem: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, key, sizes): digests and code points of the turns of each rebuilt conversation.

    Turns come by number, null first, turns of one number by their digest; a null role or text is
    empty; rows that repeat are turns that repeat; rows without a conversation id belong to none and are
    left out. Conversation c takes the first crc32(c) mod `most` turns of conversation c - c % `stem`
    (those there are) in place of as many of its own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), turn.alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    heads = own.where(F.col("conv_id") % stem == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, most).alias("head"))
    taken = own.withColumns({"h": F.expr(f"CAST(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {most} AS INT)"), "base": F.expr(f"conv_id - conv_id % {stem}")})
    rest = "slice(own, h + 1, greatest(size(own) - h, 0))"
    joined = taken.join(heads, "base", "left").withColumn("turns", F.expr(f"concat(coalesce(slice(head, 1, h), slice(own, 1, 0)), {rest})"))
    return joined.select(
        "conv_id",
        F.unhex(F.array_join(F.expr("transform(turns, t -> t.digest)"), "")).alias("key"),
        F.expr("transform(turns, t -> t.size)").alias("sizes"),
    )


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the sequences (`conv_id`, `key`, `sizes`), ids being unique.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. `key` joins digests of `WIDTH` bytes, `sizes` has a number for each. Sequences may be
    empty or repeat under many ids; these are dealt to several shards. No rows give no nodes, not even a
    root. One sequence is one row and has to fit a task.
    """
    rows = staged(rows.select("conv_id", "key", "sizes"), "trie-sequences")
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-turns // MOST), min(parts, turns // LEAST))
    ranged = rows.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    ranged = staged(ranged.withColumn("shard", F.spark_partition_id().cast("long")), "trie-order")

    order = Window.orderBy("shard")  # one row for each shard
    ends = ranged.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    ends = ends.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    near = ends.select("shard", F.expr("inline(array(named_struct('place', 0, 'key', before), named_struct('place', 2, 'key', after)))")).where("key IS NOT NULL")
    near = near.select("shard", "place", "key", F.lit(0).cast("long").alias("conv_id"), F.expr("CAST(array() AS ARRAY<BIGINT>)").alias("sizes"))
    stream = ranged.select("shard", F.lit(1).alias("place"), "key", "conv_id", "sizes").unionByName(near)
    stream = stream.repartition(shards, "shard").sortWithinPartitions("shard", "place", "key", "conv_id")
    nodes = staged(stream.mapInArrow(sorted_shards, NODES), "trie-nodes")

    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine = nodes.where("path IS NOT NULL AND chunk IS NULL")
    lists = nodes.where("chunk IS NOT NULL").select("path", "shard", "chunk", "ids")
    hashes = lists.repartition("path").sortWithinPartitions("path", "shard", "chunk").mapInArrow(whole_hashes, "path binary, ends_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = spine.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_path").alias("parent_path"), *sums)
    merged = merged.join(hashes, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    merged = staged(merged, "trie-spines")
    above = merged.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    merged = merged.join(above, "parent_path", "left")

    # Children of spine nodes look their parent up among the nodes of their own shard.
    local = spine.select("shard", F.col("path").alias("parent_path")).join(above, "parent_path")
    inner = nodes.where("path IS NULL AND parent_path IS NULL")
    below = nodes.where("path IS NULL AND parent_path IS NOT NULL").drop("parent_conv_id").join(local, ["shard", "parent_path"])
    return inner.select(*result).unionByName(below.select(*result)).unionByName(merged.select(*result))
