"""Packing of tokenised documents into sequences of fixed size by bounded-space online best fit.

Each task tokenises its documents and packs what they give: a fixed number of sequences is open, a
bitset over free space finds the one a piece fits best, and when another is needed the fullest open
one closes. A task sees pieces in blocks, the longest of a block first. What is still open when a
task ends is packed once more together with that of other tasks, so that many small tasks leave no
more half-empty sequences than a few.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged
from .words import blocks

PLACED = "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, is_open boolean"


class OpenBins:
    """At most `most` open bins; `place` yields the rows of bins that close."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_free: dict[int, list[list]] = {}
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return taken

    def _put(self, free: int, rows: list) -> None:
        self.by_free.setdefault(free, []).append(rows)
        self.bits |= 1 << free
        self.open += 1

    def place(self, length: int, row: tuple) -> list:
        """Puts a piece into the fullest bin it fits; rows of the bin that had to close, if any."""
        closed: list = []
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            rows = self._take(free)
        else:
            if self.open == self.most:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
            free, rows = self.capacity, []
            self.made += 1
        number = rows[0][-2] if rows else self.made
        rows.append((*row, number, self.capacity - free))
        if free == length:
            return closed + rows
        self._put(free - length, rows)
        return closed

    def rest(self) -> Iterator[list]:
        while self.bits:
            yield self._take((self.bits & -self.bits).bit_length() - 1)


WORD_END = re.compile(rb"[ \t-\r]")
#: Pieces that a task sorts at a time, and words whose ids it keeps at hand.
BLOCK, KEPT_WORDS = 1 << 16, 1 << 20
#: Words that are tokenised in one call.
WORDS_AT_ONCE = 128


def kept_by_process(path: str) -> dict:
    """What a worker process keeps of a vocabulary file from task to task; bounded by `KEPT_WORDS`."""
    store = sys.modules.setdefault("ledgerline_kept", types.ModuleType("ledgerline_kept"))
    read = os.stat(path)
    return store.__dict__.setdefault("words", {}).setdefault((path, read.st_mtime_ns, read.st_size), {})


def word_tokens(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Ids of texts as 32-bit numbers, for a tokenizer that never joins what white space parts.

    Each distinct word of a block is looked up once, and tokenised once while it is kept.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # An added token parts words in one call for many; words that may hold one are encoded alone.
    border = next(((i, t.content) for i, t in sorted(tokenizer.get_added_tokens_decoder().items()) if t.content), None)

    def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        out: list[array] = [array("I")] * len(words)
        alone = [i for i, w in enumerate(words) if border is None or "<" in w or border[1] in w]
        for i, e in zip(alone, tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids)
        apart = set(alone)
        rest = [i for i in range(len(words)) if i not in apart]
        chunks = [rest[at : at + WORDS_AT_ONCE] for at in range(0, len(rest), WORDS_AT_ONCE)]
        told = tokenizer.encode_batch_fast([border[1].join([words[i] for i in c]) for c in chunks], add_special_tokens=False) if chunks else []
        for chunk, e in zip(chunks, told, strict=True):
            found = array("I", e.ids)
            edges = [-1, *np.flatnonzero(np.frombuffer(found, dtype=np.uint32) == border[0]).tolist(), len(found)]
            for i, begin, end in zip(chunk, edges[:-1], edges[1:], strict=True):
                out[i] = found[begin + 1 : end]
        return np.frombuffer(b"".join(out), dtype="<u4"), np.fromiter(map(len, out), np.int64, len(out))

    nothing = pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)
    kept = kept_by_process(path)

    def ids(texts: list[bytes]) -> list[bytes]:
        known = kept.get("known", nothing)
        held = pa.array(texts, pa.large_binary()).cast(pa.large_string())
        held = pc.if_else(pc.match_substring(held, "<|"), held, pc.ascii_lower(held))
        lists = pc.ascii_split_whitespace(held)
        coded = lists.flatten().dictionary_encode()
        new = coded.dictionary.filter(pc.invert(pc.is_in(coded.dictionary, value_set=known[0])))
        if len(known[0]) + len(new) > KEPT_WORDS:
            known, new = nothing, coded.dictionary
        if len(new):
            known = pa.concat_arrays([known[0], new]), *map(np.concatenate, zip(known[1:], encoded(new.to_pylist()), strict=True))
            kept["known"] = known
        # The ids of each word occurrence, gathered from those of the distinct words.
        words, every, length = known
        which = pc.index_in(coded.dictionary, value_set=words).to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        begin, n = (np.cumsum(length) - length)[which], length[which]
        ends = np.append(0, np.cumsum(n))
        out = every[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], n)]
        edges = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [out[i:j].tobytes() for i, j in zip(edges, edges[1:], strict=False)]

    return ids


def text_parts(text: bytes, most: int = 1_000_000) -> Iterator[bytes]:
    """A long text in parts that end at white space."""
    begin = 0
    while len(text) - begin > most:
        space = WORD_END.search(text, begin + most)
        end = space.end() if space else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    open_bins: int = 256,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of each row.

    A document is its ids and `end_id`; a null text is an empty one. Only documents of more than
    `capacity` ids are cut, into pieces of that size and a rest. Every input row is packed, repeated
    rows each for itself; ids of rows may be null, other columns are not looked at. `open_bins`
    bounds a task's memory.
    """
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tokens = word_tokens(tokenizer_path)
        size = 4 * capacity
        for batch in blocks(batches, "text"):
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            known = dict(enumerate(tokens(texts))) if sum(map(len, texts)) <= 8_000_000 else {}
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                held, piece = b"", 0
                parts = [known.pop(i)] if known else (ids for part in text_parts(texts[i]) for ids in tokens([part]))
                for part in itertools.chain(parts, [end]):
                    held += part
                    at = 0
                    while len(held) - at > size:
                        yield doc, piece, piece * capacity, capacity, zlib.crc32(held[at : at + size])
                        at, piece = at + size, piece + 1
                    held = held[at:]
                yield doc, piece, piece * capacity, len(held) // 4, zlib.crc32(held)

    def placed(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        bins, block = OpenBins(capacity, open_bins), []

        def flush() -> Iterator[tuple]:
            block.sort(key=lambda r: -r[3])
            for r in block:
                for x in bins.place(r[3], r):
                    yield *x[:-2], task + x[-2], x[-1], False
            block.clear()

        for r in rows:
            block.append(r)
            if len(block) == BLOCK:
                yield from flush()
        yield from flush()
        for left in bins.rest():
            for x in left:
                yield *x[:-2], task + x[-2], x[-1], True

    kind = docs.schema[id_column].dataType
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "is_open"]
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kind), pa.int32(), *[pa.int64()] * 5, pa.bool_()]

    def batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for r in rows:
            held.append(r)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
                held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(placed(pieces(batches), TaskContext.get().partitionId() << 32))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names[:5]), strict=True))
        return batched(placed(rows, (1 << 62) + (TaskContext.get().partitionId() << 32)))

    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    schema = f"doc_id {kind.simpleString()}, {PLACED}"
    packed = staged(given.mapInArrow(first, schema), "packed")
    left = packed.where("is_open").select(*names[:5])
    ids = left.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-ids // (capacity * 4096)))
    order = [F.desc("length"), "doc_id", "piece", "ids_crc32"]
    merged = left.repartition(tasks, "doc_id", "piece").sortWithinPartitions(*order).mapInArrow(again, schema)
    return packed.where("NOT is_open").unionByName(merged).drop("is_open")
