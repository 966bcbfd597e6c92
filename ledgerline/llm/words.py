"""Words of whole texts as 64-bit numbers, computed by column for a block of documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Lower case of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A number for each byte; white space counts nothing, so that it may stand inside a sum.
BYTE = np.where(SPACE, U(0), mix(np.arange(256, dtype=np.uint64), 7))
STEP = 0xD1342543DE82EF95


def powers(n: int, step: int = STEP) -> np.ndarray:
    out = np.full(max(n, 1), U(step))
    out[0] = 1
    return np.multiply.accumulate(out)


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more entry: the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of some texts: `hash` of each, `first[i]:first[i + 1]` those of text i."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hash, self.first = hashes, first
        self.count = np.diff(first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all `k` consecutive words of one text, in order, and how many each text has."""
        n = len(self.hash) - k + 1
        counts = np.maximum(self.count - k + 1, 0)
        if n <= 0:
            return np.zeros(0, np.uint64), counts
        weights, out = powers(k, 0x2545F4914F6CDD1D), np.zeros(n, np.uint64)
        for j in range(k):
            out += self.hash[j : j + n] * weights[j]
        owner = self.owner()
        return mix(out[owner[:n] == owner[k - 1 :]], k), counts


def words_of(column, lower: bool) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text; a null text has none."""
    data, offsets = texts_of(column)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= SPACE[data[:-1]]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first)
    return Words(_numbers(data, starts), first)


#: Bytes that become numbers at a time: while that goes on, each takes about 30.
PIECE = 1 << 18


def _numbers(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of each word, some hundred kilobytes of words at a time; a longer word stands alone."""
    out, ends, begin = np.empty(len(starts), np.uint64), np.append(starts[1:], len(data)), 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + PIECE, side="right")))
        piece, at = data[starts[begin] : ends[end - 1]], starts[begin:end] - starts[begin]
        spans = np.diff(np.append(at, len(piece)))
        place = np.arange(len(piece)) - np.repeat(at, spans)
        values = BYTE[piece]
        values *= powers(int(spans.max()))[place]
        out[begin:end] = mix(np.add.reduceat(values, at))
        begin = end
    return out


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `most` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
