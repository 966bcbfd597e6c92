"""The line classifier: its sums against enumeration, its accuracy on held-out labels."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa

from ledgerline.llm import crf
from ledgerline.llm.queries import GOOD, op10_line_crf_quality


def test_marginals_equal_enumeration() -> None:
    rng = np.random.default_rng(2)
    lines = np.array([1, 4, 2, 5])
    unary, chain = rng.normal(size=12), rng.normal(size=(2, 2))
    good, pairs = crf.chain_marginals(unary, lines, chain)
    at, seen = 0, 0
    for n in lines:
        weight = np.zeros((n, 2))
        both = np.zeros((max(n - 1, 0), 2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            e = np.exp(sum(unary[at + i] * s for i, s in enumerate(y)) + sum(chain[a, b] for a, b in zip(y, y[1:])))
            for i, s in enumerate(y):
                weight[i, s] += e
            for i in range(n - 1):
                both[i, y[i], y[i + 1]] += e
        assert np.allclose(good[at : at + n], weight[:, 1] / weight.sum(axis=1))
        assert np.allclose(pairs[seen : seen + n - 1], both / weight[0].sum())
        at, seen = at + n, seen + n - 1


def test_features_of_lines() -> None:
    texts = ["Aa bb.\nAA!!\n\nAa bb.", "", None, "x x x x", "é|\n"]
    x, length, lines = crf.line_features(pa.array(texts))
    assert lines.tolist() == [4, 1, 1, 1, 2] and length.tolist() == [6, 4, 0, 6, 0, 0, 7, 3, 0]
    assert x[:, 6].tolist() == [0, 0, 0, 1, 0, 0, 0, 0, 0]  # equal to an earlier line of its text
    assert x[:, 4].tolist() == [0, 0, 0, 0, 0, 0, 0.75, 0, 0]  # words that repeat the one before
    whole = crf.line_features(pa.array(texts))[0]
    parts = np.concatenate([crf.line_features(pa.array([t]))[0] for t in texts])
    assert np.allclose(whole, parts)


def test_held_out_accuracy(spark) -> None:
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op10_line_crf_quality(spark, folder).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= GOOD) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95


def test_nulls_repeats_and_clashing_names(spark) -> None:
    docs = spark.createDataFrame([(1, None, 3.0), (1, None, 3.0), (None, "", 4.0), (2, "Fine words.\n" * 3, None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(2, 1), (2, 1), (1, 0), (3, None), (None, 1), (5, 0), (5, 1)], "doc_id long, quality int")
    model = crf.train(docs, labels, crf.F.lit(True))
    got = crf.score(docs, model)
    assert got.columns == ["doc_id", "text", "score"] and got.count() == 4
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert crf.train(docs, labels.limit(0), crf.F.lit(True)) is None
    assert {r.score for r in crf.score(docs, None).collect()} == {0.5}
    assert crf.score(docs.limit(0), model).collect() == []
