"""Removal of word sequences that already stand in an earlier document.

Every suffix of every text goes to the group of its prefix. Prefixes have variable length: those
that begin more suffixes than fit a task's memory are lengthened word by word until they do, the
rest stay short (`prefix_groups`). A group is the part of the suffix tree below its prefixes. Its
suffixes are sorted by a fingerprint of their first `k` words, which gives the internal nodes of
that depth: the leaves of a node are the places where one sequence of `k` words stands. All leaves
but those of the smallest document are repeats; adjoining ones make up a maximal repeat.

A sequence found twice among the documents of one block is resolved there and only its smallest
document travels on, so that a passage that a third of all documents share sends one suffix per
block into its group rather than one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from .words import U, Words, blocks, mix, words_of

#: Suffixes that a task holds, bytes of text in a block, bins of hashed prefixes at each length.
GROUP, BLOCK_BYTES, BINS = 1_000_000, 4_000_000, 1 << 16
#: Stands for a null id: larger than any other.
LAST = 2**63 - 1


def _prefix_bins(words: Words, at: np.ndarray, length: int) -> np.ndarray:
    """The bin of the first `length` words of the suffixes that begin at words `at`."""
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(length):
        h = mix(h ^ words.hash[at + j], j)
    return (h >> U(48)).astype(np.int64)


def _starts(words: Words, k: int) -> np.ndarray:
    """Words at which a sequence of k words of one text begins."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    owner = words.owner()
    return np.flatnonzero(owner[:n] == owner[k - 1 :])


def _groups_of(words: Words, at: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The group of each suffix; -1 where the prefix has to be longer than `levels` say."""
    group = np.full(len(at), -1, dtype=np.int64)
    open_ = np.arange(len(at))
    for length, table in enumerate(levels, start=1):
        found = table[_prefix_bins(words, at[open_], length)]
        group[open_] = found
        open_ = open_[found < 0]
        if not len(open_):
            break
    return group


def prefix_groups(docs: DataFrame, k: int, group_size: int) -> tuple[list[np.ndarray], int]:
    """For each prefix length a table from hashed prefix to group, or -1 if it has to be longer.

    Each length counts the suffixes of all texts that shorter prefixes left open. A table has a
    fixed number of bins, which is all that reaches the driver. Bins next to each other share a
    group while they fit.
    """
    levels: list[np.ndarray] = []
    groups = 0
    while len(levels) < k:
        known = list(levels)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            total = np.zeros(BINS, dtype=np.int64)
            for b in blocks(batches, "text"):
                words = words_of(b.column("text"), lower=False)
                at = _starts(words, k)
                if known:
                    at = at[_groups_of(words, at, known) < 0]
                total += np.bincount(_prefix_bins(words, at, len(known) + 1), minlength=BINS)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bin", "n"])

        counts = np.zeros(BINS, dtype=np.int64)
        for r in docs.mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
            counts[r.bin] = r.n
        table, last = np.zeros(BINS, dtype=np.int64), len(levels) + 1 == k
        held = group_size + 1
        for at in np.flatnonzero(counts):
            if counts[at] > group_size and not last:
                table[at] = -1
                continue
            if held + counts[at] > group_size:
                groups, held = groups + 1, 0
            table[at] = groups - 1
            held += counts[at]
        levels.append(table)
        if (table >= 0).all():
            break
    return levels, max(groups, 1)


def _packed(part: np.ndarray, docs: np.ndarray, hashes: np.ndarray) -> Iterator[tuple]:
    """Per part: ids of documents, how many hashes each has, and the hashes. Sorted by part and id."""
    cuts = np.flatnonzero(np.diff(part)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(part)], strict=True):
        if begin < end:
            d = docs[begin:end]
            first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            counts = np.diff(np.append(first, len(d))).astype(np.int32)
            yield int(part[begin]), d[first].tobytes(), counts.tobytes(), hashes[begin:end].tobytes()


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    docs, counts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["counts"], np.int32)
    return np.repeat(docs, counts), np.frombuffer(row["hashes"], np.uint64)


SENT = pa.schema([("part", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])
SENT_DDL = "part long, docs binary, counts binary, hashes binary"


def _later(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash and document, and which of the ordered have the hash's smallest document."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    fresh = np.append(True, h[1:] != h[:-1])[: len(h)]
    least = d[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(h) else d
    return order, d == least


def repeats(docs: DataFrame, k: int, buckets: int, group_size: int = GROUP) -> DataFrame:
    """Packed (document, fingerprint of a k-word sequence) that a smaller document has too.

    `docs` has `doc_id` (a long, no null) and `text`; `part` of the result is the bucket of the
    document among `buckets`.
    """
    docs = docs.select("doc_id", "text")
    levels, groups = prefix_groups(docs.select("text"), k, group_size)

    def bucketed(d: np.ndarray, h: np.ndarray, sign: int) -> Iterator[tuple]:
        part = (mix(d.view(np.uint64)) % U(buckets)).astype(np.int64)
        order = np.lexsort((d, part))
        return _packed(sign * part[order] - (sign < 0), d[order], h[order])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", BLOCK_BYTES):
            words = words_of(b.column("text"), lower=False)
            hashes, counts = words.windows(k)
            if not len(hashes):
                continue
            ids, group = np.repeat(b.column("doc_id").to_numpy(), counts), _groups_of(words, _starts(words, k), levels)
            del words
            order, least = _later(ids, hashes)
            hashes, ids, group = hashes[order], ids[order], group[order]
            once = np.append(True, (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]))
            send, mark = np.flatnonzero(least & once), np.flatnonzero(~least & once)
            order = send[np.lexsort((ids[send], group[send]))]
            rows = [*_packed(group[order], ids[order], hashes[order]), *bucketed(ids[mark], hashes[mark], -1)]
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist([dict(zip(SENT.names, r, strict=True)) for r in rows[at : at + 64]], schema=SENT)

    def below_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def nodes() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            ids = np.concatenate([_unpacked(r)[0] for r in held])
            hashes = np.concatenate([_unpacked(r)[1] for r in held])
            held.clear()
            order, least = _later(ids, hashes)
            order = order[~least]
            rows = list(bucketed(ids[order], hashes[order], 1))
            for at in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist([dict(zip(SENT.names, r, strict=True)) for r in rows[at : at + 256]], schema=SENT)

        for b in batches:
            for row in b.to_pylist():
                if row["part"] < 0:  # resolved within its block
                    row["part"] = -row["part"] - 1
                    yield pa.RecordBatch.from_pylist([row], schema=SENT)
                    continue
                if held and held[0]["part"] != row["part"]:
                    yield from nodes()
                held.append(row)
        yield from nodes()

    sent = docs.mapInArrow(local, SENT_DDL).repartition(groups, "part").sortWithinPartitions("part")
    return sent.mapInArrow(below_prefix, SENT_DDL)


def remove_repeats(
    docs: DataFrame, k: int = 13, id_column: str = "doc_id", text_column: str = "text", group_size: int = GROUP
) -> DataFrame:
    """All columns of `docs`, its text cut, and `n_words`, `n_removed`, `removed`, `kept_sha256`.

    A word goes if it is covered by `k` consecutive words of its text that also stand, in the same
    order, in a document with a smaller id. Sequences are judged on the input. Words are what stands
    between white space, as they are. `removed` lists the removed spans as word positions
    (`begin`, `end`), `kept_sha256` is the digest of the kept words joined by one space. A text
    keeps the white space before its kept words. Ids are whole numbers; rows with the same id
    do not cut each other; a null id counts as the largest. A null text stays null and has no words.
    Other columns pass through unless they carry one of the four new names, which are replaced.
    """
    new = ["n_words", "n_removed", "removed", "kept_sha256"]
    rest = [c for c in docs.columns if c not in (text_column, *new)]
    key = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(LAST))
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(key.alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    found = repeats(given, k, buckets, group_size)
    kind = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")).schema["rest"].dataType.simpleString()
    row = docs.select(key.alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))

    def bucket_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = (mix(b.column("doc_id").to_numpy().view(np.uint64)) % U(buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part), *b.columns], names=["part", *b.schema.names])

    placed = row.mapInArrow(bucket_of, f"part long, doc_id long, text string, rest {kind}")
    marks = found.select("part", "docs", "counts", "hashes")
    both = marks.unionByName(placed.withColumn("is_text", F.lit(True)), allowMissingColumns=True)
    both = both.select("part", F.coalesce("is_text", F.lit(False)).alias("is_text"), "doc_id", "text", "rest", "docs", "counts", "hashes")
    both = both.repartition(buckets, "part").sortWithinPartitions("part", "is_text")
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, marks = None, []
        ids, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            for b in blocks(iter([batch]), "text"):
                is_text = b.column("is_text").to_numpy(zero_copy_only=False)
                parts = b.column("part").to_numpy()
                edges = [0, *(np.flatnonzero((parts[1:] != parts[:-1]) | (is_text[1:] != is_text[:-1])) + 1), b.num_rows]
                for begin, end in zip(edges, edges[1:], strict=False):
                    piece = b.slice(begin, end - begin)
                    if parts[begin] != part:
                        part, marks = parts[begin], []
                        ids, hashes = ids[:0], hashes[:0]
                    if not is_text[begin]:
                        marks += [_unpacked(r) for r in piece.select(["docs", "counts", "hashes"]).to_pylist()]
                        continue
                    if marks:
                        ids, hashes = (np.concatenate([old, *x]) for old, x in zip((ids, hashes), zip(*marks, strict=True), strict=True))
                        order = np.argsort(ids, kind="stable")
                        ids, hashes, marks = ids[order], hashes[order], []
                    yield _cut(piece, ids, hashes)

    def _cut(b: pa.RecordBatch, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        words = words_of(b.column("text"), lower=False)
        windows, counts = words.windows(k)
        docs_ = b.column("doc_id").to_numpy()
        low, high = np.searchsorted(ids, docs_), np.searchsorted(ids, docs_, side="right")
        ends = np.cumsum(counts)
        texts, removed, digests, gone = b.column("text").to_pylist(), [], [], []
        for i in range(len(texts)):
            data = (texts[i] or "").encode()
            own = data.split()
            at = np.zeros(0, np.int64)
            if high[i] > low[i] and counts[i]:
                at = np.flatnonzero(np.isin(windows[ends[i] - counts[i] : ends[i]], hashes[low[i] : high[i]]))
            if not len(at):
                removed.append([])
                gone.append(0)
            else:
                breaks = np.flatnonzero(np.diff(at) > k)
                spans = list(zip(at[np.append(0, breaks + 1)].tolist(), (at[np.append(breaks, len(at) - 1)] + k).tolist(), strict=True))
                texts[i] = _without(data, spans).decode()
                removed.append([{"begin": x, "end": y} for x, y in spans])
                gone.append(sum(y - x for x, y in spans))
                own = [w for x, y in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(own)], strict=True) for w in own[x:y]]
            digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [b.column("rest"), pa.array(texts, pa.string()), pa.array(words.count.astype(np.int64)), pa.array(gone, pa.int64()), pa.array(removed, span), pa.array(digests, pa.string())],
            names=["rest", "text", *new],
        )

    def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
        space = np.isin(np.frombuffer(data, np.uint8), [32, 9, 10, 11, 12, 13])
        start = np.flatnonzero(~space & np.append(True, space[:-1]))
        ends = np.append(np.flatnonzero(~space & np.append(space[1:], True)) + 1, 0)
        out, at = [], 0
        for begin, end in spans:
            out.append(data[at : ends[begin - 1] if begin else 0])
            at = ends[end - 1]
        out.append(data[at:])
        kept = b"".join(out)
        return kept if spans[0][0] else kept.lstrip(b" \t\n\r\x0b\f")

    done = both.mapInArrow(cut, f"rest {kind}, text string, n_words long, n_removed long, removed array<struct<begin: long, end: long>>, kept_sha256 string")
    columns = [F.col("text").alias(text_column) if c == text_column else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in new]
    return done.select(*columns, *new)
