"""Groups of near-duplicate documents: an exact join by Jaccard similarity of word shingles.

A document is the set of its distinct `k`-word shingles. If two sets of sizes r and s reach
`num / den`, they differ in at most (den - num)(r + s) / (den + num) elements. Sizes fall into bands,
and a band cuts the universe of shingle hashes into one segment more than sets of that band may
differ in. By the pigeonhole principle two similar sets agree in some segment, which hashes of
segment subsets find. Segments in which a set has no element would match everything and are left
out; to make up for that, the first segments of a band also enter their one-deletion neighbourhood
and so tolerate one difference each. How many do is allocated by cost (`allocate`). A set that still
has too little (`Band.spare`) enters the same scheme again under another hash; two such sets meet
there. Nothing is approximate: every pair that may link becomes a candidate, and candidates are
verified on their texts.

Exact copies collapse to one set before. Candidate buckets are resolved against representatives, in
rounds: a bucket is finished when what is left of it is one component, so that thousands of mutual
near copies cost thousands of comparisons rather than millions. Before texts are fetched, parity
sketches bound from below in how many elements two sets differ, which is an exact filter too: first
short ones of one length, then ones that grow with the set, so that long texts are told apart as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bound_batches
from .components import components
from .tables import forget, maybe_in, staged
from .words import U, blocks, mix, powers, signed, words_of


@dataclass(frozen=True)
class Similarity:
    """Sets link when den * intersection >= num * union."""

    k: int = 5
    num: int = 80
    den: int = 100

    def differ(self, r: int, s: int) -> int:
        """The most elements in which linked sets of these sizes differ."""
        return (self.den - self.num) * (r + s) // (self.den + self.num)

    def partner(self, r: int) -> int:
        """The largest set that one of size r can link with."""
        return r * self.den // self.num

    def linked(self, a: set, b: set) -> bool:
        both = len(a & b)
        return self.den * both >= self.num * (len(a) + len(b) - both)


@dataclass(frozen=True)
class Band:
    low: int
    high: int
    segments: int
    deleting: int


#: Hashes tried before sets that never have enough segments share one bucket.
SEEDS = 6


def _tail(mean: float, above: int) -> float:
    """Probability that a Poisson variable exceeds `above`."""
    return max(0.0, 1 - sum(exp(-mean) * mean**i / factorial(i) for i in range(above + 1)))


def allocate(size: int, segments: int) -> int:
    """Number of segments that enter their one-deletion neighbourhood, by least expected cost.

    Cost is the number of hashes: a neighbourhood adds one for each element; too few of them send
    sets with empty segments through another hash, with all their segments again.
    """
    load = size / segments
    empty, weak = exp(-load), exp(-load) * (1 + load)

    def cost(u: int) -> float:
        again = _tail(segments * empty + u * weak, u)
        return u * load + again * segments * 1.2

    return min(range(min(segments, 60) + 1), key=cost)


#: Bands made before. A plain table: it travels with the functions that use it, a cached function would not.
MADE: dict[tuple[Similarity, int], tuple[Band, ...]] = {}


def bands(like: Similarity, most: int) -> tuple[Band, ...]:
    """Bands of sizes up to `most`; a set reaches partners in its own and the next band only."""
    if (like, most) in MADE:
        return MADE[like, most]
    if len(MADE) >= 64:
        MADE.clear()
    out, low = [], 1
    while low <= most:
        high = max(low, low * like.den**2 // like.num**2)
        while like.partner(high) > like.partner(low) and like.differ(high, high) == like.differ(low, low) == 0:
            high -= 1
        segments = like.differ(high, high) + 1
        out.append(Band(low, high, segments, allocate(high, segments)))
        low = high + 1
    MADE[like, most] = tuple(out)
    return MADE[like, most]


def shingle_sets(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their numbers."""
    words = words_of(column, lower=True)
    hashes, counts = words.windows(k)
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        weights = powers(k, 0x2545F4914F6CDD1D)
        at = np.cumsum(counts)[short] - counts[short]
        whole = [words.hash[words.first[i] : words.first[i + 1]] for i in short]
        made = np.array([(w * weights[: len(w)]).sum() + U(len(w)) for w in whole], dtype=np.uint64)
        hashes, counts = np.insert(hashes, at, mix(made, 99)), counts.copy()
        counts[short] = 1
    ends = np.cumsum(counts)
    hashes = hashes.copy()
    for begin, end in zip(ends - counts, ends, strict=True):
        hashes[begin:end].sort()
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[(ends - counts)[counts > 0]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], before[ends] - before[ends - counts]


def fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers of each set."""
    out = []
    for salt in (11, 12):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes, salt))])
        ends = np.cumsum(sizes)
        out.append(mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64), salt))
    return out[0], out[1]


def _signatures(hashes, sizes, owners, like: Similarity, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of segment subsets and deletions of sets, each with the owner of its set."""
    sigs, whose = [np.zeros(0, np.uint64)], [owners[:0]]
    if not len(sizes):
        return sigs[0], whose[0]
    table = bands(like, 2 * int(sizes.max()) + 2)
    highs = np.array([b.high for b in table])
    ends = np.cumsum(sizes)
    own = np.searchsorted(highs, sizes)
    for step in (0, 1):
        band = own + step
        low, high, m, deleting = (np.array([getattr(b, f) for b in table])[band] for f in ("low", "high", "segments", "deleting"))
        partner = np.minimum(sizes * like.den // like.num, high)
        need = (like.den - like.num) * (sizes + partner) // (like.den + like.num)
        takes = (sizes > 0) & (partner >= low) & ((need > 0) | (partner > sizes))
        idx = np.flatnonzero(takes)
        if not len(idx):
            continue
        need = need[idx] + 1
        n, mm, uu = sizes[idx], m[idx], deleting[idx]
        tokens = np.concatenate([np.arange(e - s, e) for e, s in zip(ends[idx], n, strict=True)])
        x = hashes[tokens]
        doc = np.repeat(np.arange(len(idx)), n)
        segment = ((x >> U(32)) * mm[doc].astype(np.uint64)) >> U(32)
        fresh = np.ones(len(x), dtype=bool)
        fresh[1:] = (segment[1:] != segment[:-1]) | (doc[1:] != doc[:-1])
        runs = np.flatnonzero(fresh)
        run_of = np.cumsum(fresh) - 1
        value = mix(x, 21)
        sums = np.add.reduceat(value, runs)
        length = np.diff(np.append(runs, len(x)))
        run_doc, run_segment = doc[runs], segment[runs]
        tag = mix((band[idx][run_doc].astype(np.uint64) << U(40)) + run_segment, 31 + seed)
        wide = (run_segment < uu[run_doc].astype(np.uint64)) & (length >= 2)
        sigs.append(mix(sums + tag, 41))
        whose.append(owners[idx][run_doc])
        part = np.flatnonzero(wide[run_of])
        sigs.append(mix(sums[run_of[part]] - value[part] + tag[run_of[part]], 41))
        whose.append(owners[idx][doc[part]])
        has = np.bincount(run_doc, minlength=len(idx)) + np.bincount(run_doc, weights=wide, minlength=len(idx)).astype(np.int64)
        poor = np.flatnonzero(has < need)
        if not len(poor):
            continue
        if seed + 1 == SEEDS:
            sigs.append(mix(band[idx][poor].astype(np.uint64), 51))
            whose.append(owners[idx][poor])
        else:
            again = [np.sort(mix(hashes[ends[i] - sizes[i] : ends[i]], 61 + seed)) for i in idx[poor]]
            s, w = _signatures(np.concatenate(again), n[poor], owners[idx][poor], like, seed + 1)
            sigs.append(mix(s, 71))
            whose.append(w)
    return np.concatenate(sigs), np.concatenate(whose)


def signatures(hashes, sizes, like: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) such that any two sets that link share a signature."""
    return _signatures(hashes, sizes, np.arange(len(sizes)), like)


#: Words of 64 bits in a parity sketch, and their columns.
SKETCH = 8
SKETCHES = [f"s{i}" for i in range(SKETCH)]


def parities(hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """For each set, bit i of a sketch says whether an odd number of its elements fall into cell i.

    Sets differ in at least as many elements as their sketches differ in bits.
    """
    cell = (mix(hashes, 81) >> U(55)).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    odd = np.bincount(owner * 512 + cell, minlength=len(sizes) * 512).astype(np.uint8) & 1
    words = np.packbits(odd.reshape(-1, 512), axis=1, bitorder="little").view(np.uint64)
    return [np.ascontiguousarray(words[:, i]) for i in range(SKETCH)]


def cells_of(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A parity sketch of each set with as many cells as the set has elements, rounded up to a power of 2."""
    wide = np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    owner, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(wide)
    cell = (mix(hashes, 82) & (wide - 1).astype(np.uint64)[owner]).astype(np.int64)
    odd = np.bincount((ends - wide)[owner] + cell, minlength=int(wide.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - w) // 8 : e // 8] for e, w in zip(ends.tolist(), wide.tolist(), strict=True)]


def least_difference(x: bytes, y: bytes) -> int:
    """In how many elements two sets differ at least, by the sketches of `cells_of`.

    Cells are the last bits of a hash, so that the halves of a longer sketch laid over each other are
    the sketch of half its length.
    """
    if len(x) < len(y):
        x, y = y, x
    a, b, width = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(x)
    while width > 8 * len(y):
        width //= 2
        a = (a >> width) ^ (a & ((1 << width) - 1))
    return (a ^ b).bit_count()


def document_sets(docs: DataFrame, like: Similarity, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2) of every document; a document without words has no fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            hashes, sizes = shingle_sets(b.column("text"), like.k)
            none = pa.array(sizes == 0)
            fps = [pa.compute.if_else(none, None, signed(f)) for f in fingerprints(hashes, sizes)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes.astype(np.int64)), *fps], names=["doc_id", "n_shingles", "fp1", "fp2"])

    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return given.mapInArrow(run, f"doc_id {kind}, n_shingles long, fp1 long, fp2 long")


def shared_signatures(docs: DataFrame, like: Similarity, text_column: str) -> DataFrame:
    """(sig, fp1) of signatures that sets with different fingerprints have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            hashes, sizes = shingle_sets(b.column("text"), like.k)
            fp, _ = fingerprints(hashes, sizes)
            _, once = np.unique(fp, return_index=True)
            chosen = np.zeros(len(sizes), dtype=bool)
            chosen[once] = True
            hashes = hashes[np.repeat(chosen, sizes)]
            sigs, whose = signatures(hashes, sizes[chosen], like)
            fp = fp[chosen][whose]
            for i in range(0, len(sigs), 200_000):
                yield pa.RecordBatch.from_arrays([signed(sigs[i : i + 200_000]), signed(fp[i : i + 200_000])], names=["sig", "fp1"])

    found = docs.select(F.col(f"`{text_column}`").cast("string").alias("text")).mapInArrow(run, "sig long, fp1 long")
    w = Window.partitionBy("sig")
    both = found.select("sig", "fp1", F.min("fp1").over(w).alias("_lo"), F.max("fp1").over(w).alias("_hi"))
    return both.where("_lo != _hi").select("sig", "fp1")


#: Bytes of texts whose shingles a task keeps while it verifies pairs.
KEPT_BYTES = 2_000_000


def _shingles(text: bytes, k: int) -> set:
    w = text.lower().split()
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(k)], strict=False))


def _close(pairs: DataFrame, sketches: DataFrame, like: Similarity) -> DataFrame:
    """Those of `pairs` (a, b) whose sketches do not rule out that they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, ca, nb, cb = (batch.column(c).to_pylist() for c in ("na", "ca", "nb", "cb"))
            keep = [least_difference(x, y) <= like.differ(r, s) for r, x, s, y in zip(na, ca, nb, cb, strict=True)]
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    sa, sb = (sketches.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("cells").alias(f"c{k}")) for k in "ab")
    return pairs.join(sb, "b").join(sa, "a").select("a", "b", "na", "ca", "nb", "cb").mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """Those of `pairs` (a, b) whose texts link. Texts carry the sizes and shingles that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, set] = {}
        held = 0

        def of(text: bytes) -> set:
            nonlocal held
            if text not in known:
                if held > KEPT_BYTES:
                    known.clear()
                    held = 0
                known[text] = _shingles(text, like.k)
                held += len(text)
            return known[text]

        for batch in batches:
            texts = (batch.column(c).to_pylist() for c in ("ta", "tb"))
            keep = [like.linked(of(x), of(y)) for x, y in zip(*texts, strict=True)]
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    ta, tb = (texts.select(F.col("node").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    full = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
    return full.mapInArrow(run, "a binary, b binary")


#: Texts, and bytes of texts, that a block of a component holds on average at most; shingles held at once.
BLOCK, BLOCK_BYTES, COLUMNS = 256, 4_000_000, 4096


def link_table(texts: list[bytes], like: Similarity) -> np.ndarray:
    """Which of `texts` link with which others; sets are intersected by products of 0-1 matrices."""
    number: dict[tuple, int] = {}
    sets = [[number.setdefault(x, len(number)) for x in _shingles(t, like.k)] for t in texts]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    ids = np.array([i for x in sets for i in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(ids, minlength=1) > 1  # others are in no intersection
    owner, ids = owner[shared[ids]], (np.cumsum(shared) - 1)[ids[shared[ids]]]
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for low in range(0, int(shared.sum()), COLUMNS):
        begin, end = np.searchsorted(ids, (low, low + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - low)), dtype=np.float32)
        has[owner[begin:end], ids[begin:end] - low] = 1
        both += (has @ has.T).astype(np.int64)
    linked = like.den * both >= like.num * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    return linked


def link_counts(comps: DataFrame, classes: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """(node, linked): how many rows have a set that links with the node's set, copies of it left out.

    Whatever links is in one component. The texts of a component are dealt out to blocks by hash;
    every two blocks meet once, so that each pair is verified once. Pairs are no rows: a task holds
    two blocks at a time and gives one sum for each of their texts.
    """
    members = comps.join(texts, "node").join(classes.select("node", "copies"), "node")
    parts = members.groupBy("comp").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.length("text")) / BLOCK_BYTES)).cast("int").alias("_parts")
    )
    dealt = members.join(parts, "comp").withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    dealt = dealt.select("comp", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "node", "copies", "text")
    dealt = dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")

    def count(at: tuple, rows: list[list]) -> pa.RecordBatch:
        own, node, copies, text = zip(*rows, strict=True)
        linked = link_table(list(text), like)
        if at[1] != at[2]:  # pairs within a block are verified where it meets itself
            linked &= np.not_equal.outer(own, own)
        return pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(linked @ np.array(copies, dtype=np.int64))], names=["node", "linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for comp, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (comp, i, j) != at:
                    if held:
                        yield count(at, held)
                    at, held = (comp, i, j), []
                held.append(row)
        if held:
            yield count(at, held)

    return dealt.mapInArrow(run, "node binary, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def _node(fp1: str = "fp1", fp2: str = "fp2"):
    return F.unhex(F.concat(F.lpad(F.hex(fp1), 16, "0"), F.lpad(F.hex(fp2), 16, "0")))


def near_duplicates(
    docs: DataFrame, like: Similarity = Similarity(), id_column: str = "doc_id", text_column: str = "text", count_links: bool = True
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of `docs`.

    Words are what stands between white space, A-Z in lower case; a text with fewer words than `k`
    is one shingle. `component_id` is the smallest id that links lead to, the own one included. Rows
    without text or words link with nothing. Every input row gives one row; rows that repeat an id
    are documents that share it; a null id is never the smallest, and a component of null ids has
    none. Columns other than the two named are not looked at. `n_links` counts the other rows that the
    row links with, all of them verified: exact copies of its set and rows whose sets reach the
    similarity. It takes a comparison of all texts of a component; without `count_links` it is left out.
    """
    bound_batches(docs.sparkSession)
    sets = staged(document_sets(docs, like, id_column, text_column), "sets")
    classes = sets.where("fp1 IS NOT NULL").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes.withColumn("node", _node()), "classes")
    member = staged(shared_signatures(docs, like, text_column).distinct(), "signatures")
    # Signatures with the same members say the same: one of them stays.
    alike = member.groupBy("sig").agg(
        F.bit_xor(F.xxhash64("fp1")).alias("_x"), F.sum(F.xxhash64("fp1", F.lit(1)).bitwiseAND(F.lit(2**40 - 1))).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    stays = alike.groupBy("_x", "_s", "_n").agg(F.min("sig").alias("sig")).select("sig")
    bucket = member.join(stays, "sig", "left_semi").join(classes.select("fp1", "node"), "fp1").select("sig", "node")
    bucket = staged(bucket, "buckets")
    forget(member)
    nodes = bucket.select("node").distinct().join(classes, "node").select("node", "fp1", "fp2", F.col("rep").alias("doc_id"))
    nodes = staged(nodes, "nodes")
    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    sketches = _sketches(given, nodes, like)
    comps = _linked(bucket, given, nodes, sketches, like)
    forget(sketches)
    joined = classes.join(comps, "node", "left").select("fp1", "fp2", "rep", "copies", F.coalesce("comp", "node").alias("comp"), F.col("comp").isNotNull().alias("_linked"))
    joined = staged(joined.where("_linked OR copies > 1"), "joined")
    if not count_links:
        forget(nodes, comps)
    least = joined.groupBy("comp").agg(F.min("rep").alias("component_id"))
    found = joined.join(least, "comp").select("fp1", "fp2", "component_id", "copies")
    if count_links:
        texts = _texts(given, nodes, comps, like)
        linked = staged(link_counts(comps, classes, texts, like), "linked")
        forget(nodes, texts, comps)
        linked = classes.select("fp1", "fp2", "node").join(linked, "node").drop("node")
        found = found.join(linked, ["fp1", "fp2"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    component = F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    counts = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if count_links else []
    return sets.join(found, ["fp1", "fp2"], "left").select("doc_id", "n_shingles", component, *counts)


def _rows_of(given: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of documents that `nodes` name, and few others: a bounded filter keeps most out of the shuffle."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return maybe_in(given.withColumn("doc_id", name), "doc_id", nodes.select(name.alias("_key")), "_key").select("text")


def _sketches(given: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """(node, n, s0.., cells): size and sketches of every set that shares a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            hashes, sizes = shingle_sets(b.column("text"), like.k)
            columns = [*fingerprints(hashes, sizes), *parities(hashes, sizes)]
            yield pa.RecordBatch.from_arrays(
                [*map(signed, columns), pa.array(sizes.astype(np.int64)), pa.array(cells_of(hashes, sizes), pa.binary())],
                names=["fp1", "fp2", *SKETCHES, "n", "cells"],
            )

    kinds = "".join(f"{c} long, " for c in ("fp1", "fp2", *SKETCHES, "n"))
    own = _rows_of(given, nodes).mapInArrow(run, f"{kinds}cells binary")
    one = own.groupBy("fp1", "fp2").agg(F.min(F.struct("n", *SKETCHES, "cells")).alias("_t"))
    return staged(one.join(nodes.drop("doc_id"), ["fp1", "fp2"]).select("node", "_t.*"), "sketches")


def _texts(given: DataFrame, nodes: DataFrame, asked: DataFrame, like: Similarity) -> DataFrame:
    """(node, text) of the nodes in `asked`: one document's text each. The documents are read anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            hashes, sizes = shingle_sets(b.column("text"), like.k)
            yield pa.RecordBatch.from_arrays([*map(signed, fingerprints(hashes, sizes)), b.column("text").cast(pa.binary())], names=["fp1", "fp2", "text"])

    nodes = staged(nodes.join(asked.select("node").distinct(), "node", "left_semi"), "asked")
    own = _rows_of(given, nodes).mapInArrow(run, "fp1 long, fp2 long, text binary")
    one = own.groupBy("fp1", "fp2").agg(F.min("text").alias("text"))
    out = staged(one.join(nodes.drop("doc_id"), ["fp1", "fp2"]).select("node", "text"), "texts")
    forget(nodes)
    return out


#: The rest of all buckets is compared at once when it takes no more pairs than this for each member.
PAIRS_PER_MEMBER = 16


def _linked(bucket: DataFrame, given: DataFrame, nodes: DataFrame, sketches: DataFrame, like: Similarity) -> DataFrame:
    """(node, comp) of sets that link with others, by as many verified links as components need.

    In each round some members of every bucket, first those that stand in most buckets, are held
    against all members of other components. They are then done: whatever they link with is known.
    Members have a place in their bucket from the start, so that what is done is a range of places.
    A bucket ends when the members that are not done are of one component. When few pairs are left
    all are compared, else the number taken grows by `PAIRS_PER_MEMBER` times; no pair that may link is
    left out. Texts are fetched only for pairs that the sketches leave, which are few: what moves in a
    round are places and sketches.
    """
    often = bucket.groupBy("node").agg(F.count(F.lit(1)).alias("_often"))
    order = Window.partitionBy("sig").orderBy(F.desc("_often"), "node")
    placed = bucket.join(often, "node").select("sig", "node", F.row_number().over(order).alias("place"))
    carried = ["node", "place", "n", *SKETCHES]
    sketched = placed.join(sketches.drop("cells"), "node")
    rest = staged(sketched.select("sig", *carried, F.col("node").alias("comp")), "rest")
    comps, done, take, final = None, 0, 1, False
    named = {"rep": "node", **{f"rep_{c}": c for c in ("comp", "n", *SKETCHES)}}
    reps = [F.col(column).alias(name) for name, column in named.items()]

    while not rest.isEmpty():
        if final:
            sizes = rest.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("_n"))
            largest = sizes.groupBy("sig").agg(F.max(F.struct("_n", "comp")).alias("_l")).select("sig", F.col("_l.comp").alias("_largest"))
            first = rest.join(largest, "sig").where("comp != _largest").select("sig", *reps)
        else:
            first = rest.where(F.col("place") <= done + take).select("sig", *reps)
        # Pairs whose sketches differ too much are no rows of the join.
        apart = " + ".join(f"bit_count({c} ^ rep_{c})" for c in SKETCHES)
        may = F.expr(f"comp != rep_comp AND greatest({apart}, abs(n - rep_n)) <= {like.den - like.num} * (n + rep_n) DIV {like.den + like.num}")
        pairs = first.alias("f").join(rest.alias("r"), (F.col("f.sig") == F.col("r.sig")) & may)
        pairs = pairs.select(F.least("rep", "node").alias("a"), F.greatest("rep", "node").alias("b")).distinct()
        close = staged(_close(pairs, sketches, like), "close")
        if close.isEmpty():
            found = close
        else:
            texts = _texts(given, nodes, close.select(F.explode(F.array("a", "b")).alias("node")), like)
            found = staged(_verified(close, texts, like), "verified")
            forget(close, texts)
        if comps is None:
            comps = components(found)
        else:  # what the new links add, between the components so far
            ca, cb = (comps.select(F.col("node").alias(k), F.col("comp").alias(f"c{k}")) for k in "ab")
            drawn = found.join(ca, "a", "left").join(cb, "b", "left")
            added = components(drawn.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
            known = comps.unionByName(added.select("node", F.col("node").alias("comp")).join(comps, "node", "left_anti"))
            moved = added.select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
            before, comps = comps, staged(known.join(moved, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp")), "components")
            forget(before, added)
        forget(found)
        if final:
            break
        done, take = done + take, take * PAIRS_PER_MEMBER
        left = rest.where(F.col("place") > done).drop("comp").join(comps, "node", "left")
        left = staged(left.select("sig", *carried, F.coalesce("comp", "node").alias("comp")), "left")
        forget(rest)
        members = F.bit_xor(F.xxhash64("node")).alias("_x"), F.sum(F.xxhash64("node", F.lit(1)).bitwiseAND(F.lit(2**40 - 1))).alias("_s")
        sizes = left.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("_n"), *members).groupBy("sig")
        several = sizes.agg(
            F.sum("_n").alias("_all"), F.sum(F.col("_n") * F.col("_n")).alias("_same"), F.count(F.lit(1)).alias("_c"), F.bit_xor("_x").alias("_x"), F.sum("_s").alias("_s")
        ).where("_c > 1")
        # Buckets that have come to hold the same members say the same: one of them stays.
        several = several.groupBy("_x", "_s", "_all", "_same").agg(F.min("sig").alias("sig"))
        several = staged(several.select("sig", "_all", "_same"), "several")
        open_ = several.agg(F.sum("_all"), F.sum(F.col("_all") * F.col("_all") - F.col("_same"))).first()
        rest = staged(left.join(several.select("sig"), "sig", "left_semi"), "rest")
        forget(left, several)
        final = (open_[1] or 0) <= 2 * PAIRS_PER_MEMBER * (open_[0] or 0)
    forget(rest)
    if comps is None:
        return bucket.select("node", F.col("node").alias("comp")).limit(0)
    forget(bucket)
    return comps
