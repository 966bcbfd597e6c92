"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts are quantised on a logarithmic scale; an n-gram of level q is entered as (n-gram, 1) to
(n-gram, q). Its level is read back by asking for (n-gram, 1), (n-gram, 2), ... until one is missing.
An entry sets a few bits within one 64-bit word. The filter is built in slices by n-gram hash, each
sized by the n-grams it holds, so that it grows with the corpus at a steady error rate. Slices are
broadcast as many at a time as a documented bound allows; beyond it documents are passed on with the
levels found so far and meet the next slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import staged
from .words import U, Words, blocks, mix, words_of

END, BEGIN = U(0x656E64), U(0x626567)
#: Bits of the filter for each entry, bits an entry sets, highest level (of counts from 2^47 on).
BITS, SET, LEVELS = 10, 5, 48
#: Bytes of text whose n-grams are counted before they are sent, and that are split into words at a time:
#: while that goes on, each byte takes about 30.
BLOCK_BYTES, WORD_BYTES = 4_000_000, 1_000_000


def tokens_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and one end per text as numbers, what stands before each, and tokens per text."""
    counts = words.count + 1
    ends = np.cumsum(counts) - 1
    token = np.empty(int(counts.sum()), dtype=np.uint64)
    inner = np.ones(len(token), dtype=bool)
    inner[ends] = False
    token[inner], token[ends] = words.hash, END
    before = np.empty_like(token)
    before[1:], before[ends - counts + 1] = token[:-1], BEGIN
    return token, before, counts


def pair_of(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * U(0x9FB21C651E98DF25) + token, 2)


def level_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, LEVELS)


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0, exact for 1."""
    return np.where(level > 0, (2.0 ** (level - 1) + 2.0**level - 1) / 2, 0.0)


def _place(key: np.ndarray, level: int | np.ndarray, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(key ^ (np.asarray(level).astype(np.uint64) * U(0xA0761D6478BD642F)), 3)
    mask = np.zeros(len(h), dtype=np.uint64)
    for i in range(SET):
        mask |= U(1) << ((h >> U(6 * i)) & U(63))
    return ((h >> U(32)) * np.asarray(words).astype(np.uint64)) >> U(32), mask


def build_slice(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter of some n-grams as 64-bit words."""
    levels = level_of(counts)
    size = max(1, -(-int(levels.sum()) * BITS // 64))
    bits = np.zeros(size, dtype=np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, mask = _place(keys[levels >= level], level, size)
        np.bitwise_or.at(bits, at.astype(np.int64), mask)
    return bits


class Filter:
    """Slices of the filter end to end; `sizes[i]` is 0 for a slice that is not held."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.begin = np.cumsum(sizes) - sizes

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 for those it does not hold."""
        out = np.zeros(len(keys), dtype=np.uint8)
        part = part_of(keys, len(self.sizes))
        open_ = np.flatnonzero(self.sizes[part] > 0)
        for level in range(1, LEVELS + 1):
            if not len(open_):
                break
            p = part[open_]
            at, mask = _place(keys[open_], level, self.sizes[p])
            open_ = open_[(self.bits[at.astype(np.int64) + self.begin[p]] & mask) == mask]
            out[open_] = level
        return out


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((mix(keys, 5) >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


class Vocabulary:
    """Exact counts of single tokens, keys in order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


COUNTS = pa.schema([("part", pa.int64()), ("single", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary())])
SLICES = pa.schema([("part", pa.int64()), ("single", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("bits", pa.binary()), ("size", pa.int64())])


def ngram_slices(texts: DataFrame, parts: int) -> DataFrame:
    """One row per slice: exact counts of its single tokens, and its part of the filter.

    N-grams of a block are counted before they are sent, as arrays to the slice they belong to. Each
    slice is put together by one task, so that `parts` sets the memory a task needs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in blocks(batches, "text", BLOCK_BYTES):
            found: tuple[list, list] = ([], [])
            for b in blocks(iter([big]), "text", WORD_BYTES):
                token, before, _ = tokens_of(words_of(b.column("text"), lower=True))
                for keys, out in ((token, found[0]), (pair_of(before, token), found[1])):
                    out.append(np.unique(keys, return_counts=True))
            for single, out in ((True, found[0]), (False, found[1])):
                keys, counts = summed(*(np.concatenate(x) for x in zip(*out, strict=True)))
                part = part_of(keys, parts)
                order = np.argsort(part, kind="stable")
                keys, counts, part = keys[order], counts[order], part[order]
                cuts = np.append(0, np.cumsum(np.bincount(part, minlength=parts)))
                rows = [(i, single, keys[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                for i in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(COUNTS.names, r, strict=True)) for r in rows[i : i + 64]], schema=COUNTS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}

        def out(part: int) -> pa.RecordBatch:
            nothing = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            single, n = summed(*map(np.concatenate, zip(*held.pop((part, True), nothing), strict=True)))
            pairs, m = summed(*map(np.concatenate, zip(*held.pop((part, False), nothing), strict=True)))
            bits = build_slice(np.concatenate([single, pairs]), np.concatenate([n, m]))
            row = [part, True, single.tobytes(), n.astype(np.int64).tobytes(), int(n.sum()), len(single), bits.tobytes(), len(bits)]
            return pa.RecordBatch.from_pylist([dict(zip(SLICES.names, row, strict=True))], schema=SLICES)

        last = None
        for b in batches:
            for r in b.to_pylist():
                if last is not None and r["part"] != last:
                    yield out(last)
                last = r["part"]
                held.setdefault((last, r["single"]), []).append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
        if last is not None:
            yield out(last)

    sent = texts.select("text").mapInArrow(count, "part long, single boolean, keys binary, counts binary")
    sent = sent.repartition(parts, "part").sortWithinPartitions("part")
    return sent.mapInArrow(build, "part long, single boolean, keys binary, counts binary, tokens long, types long, bits binary, size long")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def score_texts(
    docs: DataFrame, train: Column, weight: float = 0.2, parts: int | None = None,
    broadcast_bytes: int = 256_000_000, vocabulary_rows: int = 12_000_000,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of `docs`.

    Rows for which `train` holds teach the counts, `held_out` is its opposite. Tokens are words,
    A-Z in lower case, and one end per text; a null text is an empty one. `base_score` is the log10
    probability by add-one counts of single tokens, `score` that of the model: `weight` times the
    share of the token among what followed the one before it, and the rest by single tokens, all
    from the filter. Single-token counts of the base are exact: they are broadcast up to
    `vocabulary_rows` distinct tokens and joined by a shuffle beyond. `broadcast_bytes` bounds the
    slices of the filter that are broadcast at a time, `parts` (by default the number of shuffle
    partitions) how many slices there are. Other columns are ignored; repeated rows count each.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(~train, F.lit(False)).alias("held_out"), F.col(f"`{text_column}`").cast("string").alias("text"))
    slices = staged(ngram_slices(given.where("NOT held_out"), parts), "slices")
    row = slices.agg(F.sum("tokens"), F.sum("types")).first()
    total, types = int(row[0] or 0), int(row[1] or 0)
    texts = given.where("NOT held_out").count()
    rounds: list[list[int]] = [[]]
    room = broadcast_bytes
    for r in slices.select("part", "size").orderBy("part").collect():
        if rounds[-1] and room < 8 * r["size"]:
            rounds.append([])
            room = broadcast_bytes
        rounds[-1].append(r["part"])
        room -= 8 * r["size"]
    exact = types <= vocabulary_rows
    words = None
    if exact:
        held = [(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)) for r in slices.select("keys", "counts").toLocalIterator()]
        words = spark.sparkContext.broadcast(summed(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        del held

    def probe(last: bool, filter_) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Filter(*filter_.value)
            vocabulary = Vocabulary(*words.value) if exact else None
            for b in blocks(batches, "text", WORD_BYTES):
                token, before, counts = tokens_of(words_of(b.column("text"), lower=True))
                once, back = np.unique(token, return_inverse=True)
                single = known.levels(once)[back]
                pair = known.levels(pair_of(before, token))
                if "levels" in b.schema.names:
                    old = np.frombuffer(b"".join(b.column("levels").to_pylist()), np.uint8).reshape(-1, 2)
                    single, pair = np.maximum(single, old[:, 0]), np.maximum(pair, old[:, 1])
                ends = np.cumsum(counts)
                if not last:
                    both = np.stack([single, pair], axis=1)
                    held = [both[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), b.column("text"), pa.array(held, pa.binary())], names=["doc_id", "held_out", "text", "levels"])
                    continue
                first = ends - counts
                c_single, c_pair = count_of(single.astype(np.int64)), count_of(pair.astype(np.int64))
                context = np.empty_like(c_single)
                context[1:], context[first] = c_single[:-1], texts
                context = np.maximum(context, c_pair)
                p = (c_single + 1) / (total + types + 1)
                p = np.where(context > 0, (1 - weight) * p + weight * c_pair / np.maximum(context, 1), p)
                score = np.add.reduceat(np.log10(np.minimum(p, 1.0)), first)
                if exact:
                    c = vocabulary.counts_of(once)[back]
                    n_known = np.add.reduceat((c > 0).astype(np.int64), first)
                    base = np.add.reduceat(np.log10((c + 1) / (total + types + 1)), first)
                else:
                    n_known, base = np.zeros(len(first), np.int64), np.zeros(len(first))
                columns = [b.column("doc_id"), b.column("held_out"), pa.array(counts.astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(score)]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
                if "row" in b.schema.names:
                    columns, names = [*columns, b.column("row")], [*names, "row"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return run

    state = given
    if not exact:  # rows meet their exact counts by number; the filter goes another way
        state = staged(given.withColumn("row", F.monotonically_increasing_id()), "texts")
        given = state
    for i, chosen in enumerate(rounds):
        held = {r["part"]: np.frombuffer(r["bits"], np.uint64) for r in slices.where(F.col("part").isin(chosen)).select("part", "bits").toLocalIterator()}
        sizes = np.array([len(held.get(p, ())) for p in range(parts)], dtype=np.int64)
        bits = np.concatenate([held.pop(p) for p in sorted(held)]) if held else np.zeros(0, np.uint64)
        filter_ = spark.sparkContext.broadcast((sizes, bits))
        last = i + 1 == len(rounds)
        if last:
            extra = "" if exact else ", row long"
            state = state.mapInArrow(probe(True, filter_), f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double{extra}")
        else:
            state = staged(_carrying_row(state, probe(False, filter_), id_kind, exact), "levels")
    if not exact:
        state = state.drop("n_known", "base_score").join(_base_by_join(given, slices, total, types), "row").drop("row")
    return state.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _carrying_row(state: DataFrame, run, id_kind: str, exact: bool) -> DataFrame:
    if exact:
        return state.mapInArrow(run, f"doc_id {id_kind}, held_out boolean, text string, levels binary")

    def with_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", WORD_BYTES):
            for out in run(iter([b])):
                yield out.append_column("row", b.column("row"))

    return state.mapInArrow(with_row, f"doc_id {id_kind}, held_out boolean, text string, levels binary, row long")


def _base_by_join(given: DataFrame, slices: DataFrame, total: int, types: int) -> DataFrame:
    """(row, n_known, base_score) with exact counts met by a shuffle on the token."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", WORD_BYTES):
            token, _, counts = tokens_of(words_of(b.column("text"), lower=True))
            row = np.repeat(np.arange(b.num_rows), counts)
            order = np.lexsort((token, row))
            token, row = token[order], row[order]
            first = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (row[1:] != row[:-1])))
            n = np.diff(np.append(first, len(token)))
            yield pa.RecordBatch.from_arrays([pa.array(b.column("row").to_numpy()[row[first]]), pa.array(token[first].view(np.int64)), pa.array(n)], names=["row", "key", "n"])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r[c], np.int64)) for c in ("keys", "counts")], names=["key", "c"])

    known = slices.select("keys", "counts").mapInArrow(counts, "key long, c long")
    asked = given.select("row", "text").mapInArrow(tokens, "row long, key long, n long")
    met = asked.join(known, "key", "left")
    c = F.coalesce("c", F.lit(0))
    return met.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(total + types + 1))).alias("base_score"),
    )


def crc_text(column: str) -> Column:
    """Checksum of a value's text, as an unsigned number."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary"))

