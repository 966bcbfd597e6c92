"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line itself and its neighbours; a chain links
the labels of adjoining lines. Forward and backward sums give each line's probability of being good,
and their mean weighted by line length, put on the scale of labels, is the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from .tables import maybe_in
from .words import BYTE, SPACE, blocks, mix, powers, texts_of, words_of

CLASSES = [b" \t\r\x0b\x0c", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b"#*$%&<>@^~_=+", b"|", b"!", b".", b",;:?", b"()[]{}\"'", b"/\\", bytes(range(128, 256))]

#: The class of each byte, counted from 1; other bytes and line ends are of none.
CLASS = np.zeros(256, dtype=np.int64)
for _number, _chars in enumerate(CLASSES, start=1):
    CLASS[list(_chars)] = _number


def line_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of some texts, their lengths in bytes, and lines per text (1 at least)."""
    data, offsets = texts_of(column)
    breaks = np.flatnonzero(data == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    lines = np.searchsorted(breaks, offsets[1:], "left") - np.searchsorted(breaks, offsets[:-1], "left") + 1
    first = np.cumsum(lines) - lines
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts[first] = offsets[:-1]
    length = np.maximum(ends - starts, 0)
    n = np.maximum(length, 1).astype(np.float64)

    def per_line(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[starts + length] - sums[starts]

    kinds = len(CLASSES) + 1
    at = np.repeat(np.arange(len(starts)) * kinds, np.diff(np.append(starts, len(data)))) + CLASS[data]
    shares = (np.bincount(at, minlength=kinds * len(starts)).reshape(-1, kinds)[:, 1:] / n[:, None]).T
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]
    words = per_line(begins)
    hashes = words_of(column, lower=True).hash
    wfirst = np.cumsum(words) - words
    same = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes):
        repeat = np.append(False, hashes[1:] == hashes[:-1])
        repeat[wfirst[words > 0]] = False
        same[1:] = np.cumsum(repeat)
    wn = np.maximum(words, 1)
    again = (same[wfirst + words] - same[wfirst]) / wn
    values = BYTE[data] * powers(int(length.max(initial=0)) + 2)[np.minimum(np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))), length.max(initial=0) + 1)] if len(data) else np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    line_hash = mix(sums[starts + length] - sums[starts])
    doc = np.repeat(np.arange(len(lines)), lines)
    order = np.lexsort((np.arange(len(doc)), line_hash, doc))
    dup = np.zeros(len(doc))
    if len(doc):
        later = np.append(False, (line_hash[order][1:] == line_hash[order][:-1]) & (doc[order][1:] == doc[order][:-1]))
        dup[order[later]] = 1
    dup[length == 0] = 0
    own = np.column_stack(
        [np.ones(len(doc)), np.log1p(length), np.log1p(words), (length / wn) / 10, again, again > 0.3, dup, length == 0, *shares, (shares[1] > 0.3), (shares[4] > 0.04), (shares[5] > 0.02), (shares[6] > 0.04)]
    )
    around = own[:, 1:]
    before, after = np.zeros_like(around), np.zeros_like(around)
    before[1:], after[:-1] = around[:-1], around[1:]
    last = first + lines - 1
    before[first], after[last] = 0, 0
    edge = np.zeros((len(doc), 2))
    edge[first, 0], edge[last, 1] = 1, 1
    return np.hstack([own, before, after, edge]), length, lines


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    chain: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def unary(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def marginals(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return chain_marginals(self.unary(x), lines, self.chain)[0]

    def score(self, x: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
        good = weighted(self.marginals(x, lines), length, lines)
        return 1 / (1 + np.exp(-(self.slope * logit(good) + self.offset)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def weighted(values: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
    first = np.cumsum(lines) - lines
    weight = length + 1e-3
    return np.add.reduceat(values * weight, first) / np.add.reduceat(weight, first)


def chain_marginals(unary: np.ndarray, lines: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and of each line but the first of a text the 2 x 2 table with the line before.

    All texts advance together, a line a step; the longest come first, so that those still running
    are a slice.
    """
    n = len(unary)
    order = np.argsort(-lines, kind="stable")
    first = (np.cumsum(lines) - lines)[order]
    running = np.searchsorted(-lines[order], -np.arange(1, lines.max(initial=0) + 1), side="right")
    node = np.stack([np.zeros(n), unary], axis=1)
    alpha, beta = node.copy(), np.zeros((n, 2))
    for t in range(1, len(running)):
        at = first[: running[t]] + t
        prev = alpha[at - 1]
        alpha[at, 0] += np.logaddexp(prev[:, 0] + chain[0, 0], prev[:, 1] + chain[1, 0])
        alpha[at, 1] += np.logaddexp(prev[:, 0] + chain[0, 1], prev[:, 1] + chain[1, 1])
    for t in range(len(running) - 1, 0, -1):
        at = first[: running[t]] + t
        follow = beta[at] + node[at]
        beta[at - 1, 0] = np.logaddexp(follow[:, 0] + chain[0, 0], follow[:, 1] + chain[0, 1])
        beta[at - 1, 1] = np.logaddexp(follow[:, 0] + chain[1, 0], follow[:, 1] + chain[1, 1])
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    total = np.logaddexp(both[:, 0], both[:, 1])
    later = np.ones(n, dtype=bool)
    later[first] = False
    at = np.flatnonzero(later)
    pairs = alpha[at - 1][:, :, None] + chain[None] + (node[at] + beta[at])[:, None, :] - total[at][:, None, None]
    return good, np.exp(np.minimum(pairs, 0))


def fit(x: np.ndarray, length: np.ndarray, lines: np.ndarray, label: np.ndarray, steps: int = 60) -> Model:
    """Likelihood of labels that all lines of a text share, by gradient steps from a logistic start."""
    y = np.repeat(label.astype(np.float64), lines)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[scale < 1e-9] = 0, 1
    z = (x - mean) / scale
    z[:, 0] = 1
    # A text counts once whatever its number of lines.
    share = np.repeat(1 / np.maximum(lines, 1), lines) * len(y) / max(len(lines), 1)
    w = np.zeros(z.shape[1])
    for _ in range(8):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (share * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + 1.0 * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (share * (y - p)) - 1.0 * w)
    chain = np.zeros((2, 2))
    first = np.cumsum(lines) - lines
    later = np.ones(len(y), dtype=bool)
    later[first] = False
    at = np.flatnonzero(later)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), share[at])
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, steps + 1):
        good, pairs = chain_marginals(z @ w, lines, chain)
        gradient = np.append(z.T @ (share * (y - good)) - 1.0 * w, (seen - (pairs * share[at][:, None, None]).sum(axis=0) - 1.0 * chain).ravel()) / len(y)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, chain = w + move[:-4], chain + move[-4:].reshape(2, 2)
    model = Model(mean, scale, w, chain)
    s = logit(weighted(chain_marginals(z @ w, lines, chain)[0], length, lines))
    a = np.array([0.1, 0.0])
    basis = np.column_stack([s, np.ones(len(s))])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(basis @ a, -30, 30)))
        h = (basis * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ basis + 1e-2 * np.eye(2)
        a = a + np.linalg.solve(h, basis.T @ (label - p) - 1e-2 * a)
    model.slope, model.offset = float(max(a[0], 1e-3)), float(a[1])
    return model


def train(docs: DataFrame, labels: DataFrame, use: Column, most_docs: int = 4000, id_column: str = "doc_id", text_column: str = "text") -> Model | None:
    """A model from at most `most_docs` labelled documents for which `use` (of doc_id) holds.

    The bound is on documents; each is read whole. Chosen are the labels with the smallest hashes of
    their ids, the same in every run. A label is `quality` 0 or 1; others, null ids and ids with two
    different labels teach nothing. None if no label is left.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(use).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("_other")).where("quality = _other").drop("_other")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    rows = {r.doc_id: r.quality for r in chosen.collect()}
    if not rows:
        return None
    ids = docs.sparkSession.createDataFrame(list(rows.items()), f"doc_id {known.schema['doc_id'].dataType.simpleString()}, quality int")
    given = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    given = maybe_in(given, "doc_id", ids.select(F.col("doc_id").alias("_key")), "_key").join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            x, length, lines = line_features(b.column("text"))
            at = np.append(0, np.cumsum(lines))
            cut = [(x[i:j].astype(np.float32).tobytes(), length[i:j].tobytes()) for i, j in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary())], names=["doc_id", "quality", "x", "length"])

    kind = known.schema["doc_id"].dataType.simpleString()
    seen = given.select("doc_id", "quality", "text").mapInArrow(run, f"doc_id {kind}, quality int, x binary, length binary")
    seen = sorted(seen.collect(), key=lambda r: (r.doc_id, r.length, r.x))
    if not seen:
        return None
    length = [np.frombuffer(r.length, np.int64) for r in seen]
    lines = np.array([len(n) for n in length])
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(len(n), -1) for r, n in zip(seen, length, strict=True)]).astype(np.float64)
    return fit(x, np.concatenate(length), lines, np.array([r.quality for r in seen], dtype=np.float64))


def score(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """`docs` with `score`, the probability of label 1, from the whole text of each row.

    Null and empty texts are one empty line. Without a model every score is 0.5. A column named
    `score` is replaced, all others pass through; repeated rows are scored each.
    """
    bound_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != "score"]
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{text_column}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "_text"):
            scores = np.full(b.num_rows, 0.5) if model is None else model.score(*line_features(b.column("_text")))
            yield pa.RecordBatch.from_arrays([b.column("rest"), pa.array(scores)], names=["rest", "score"])

    done = given.mapInArrow(run, f"rest {given.schema['rest'].dataType.simpleString()}, score double")
    return done.select(*[F.col(f"rest.`{c}`").alias(c) for c in rest], "score")
