"""Removal of repeated word sequences against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.substrings import remove_repeats


def brute(rows, k):
    first: dict[tuple, int] = {}
    key = lambda d: 2**63 if d is None else d
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - k + 1):
            s = tuple(w[i : i + k])
            first[s] = min(first.get(s, 2**64), key(doc))
    out = []
    for doc, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < key(doc):
                gone.update(range(i, i + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def corpus(rng: random.Random) -> list[tuple]:
    words = [f"w{i}" for i in range(300)]
    passages = [rng.choices(words, k=rng.randint(10, 40)) for _ in range(12)]
    rows = []
    for i in range(150):
        w = rng.choices(words, k=rng.randint(0, 60))
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = p
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(200, rows[3][1]), (3, rows[9][1]), (None, rows[5][1]), (None, rows[5][1]), (300, None), (301, ""), (302, "same " * 50), (303, "same " * 14)]
    return rows


@pytest.mark.parametrize("group_size", [2_000_000, 60])
def test_equals_brute_force(spark, rng, group_size) -> None:
    rows = corpus(rng)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).repartition(4)
    got = remove_repeats(df, 13, group_size=group_size)
    assert got.columns == ["doc_id", "text", "part", "n_words", "n_removed", "removed", "kept_sha256"]
    assert result(got) == brute(rows, 13)
    for r in got.collect():
        own = (r.text or "").encode().split()
        assert hashlib.sha256(b" ".join(own)).hexdigest() == r.kept_sha256
        assert sum(s.end - s.begin for s in r.removed) == r.n_removed and r.part == "clash"


def test_empty_table_and_long_text(spark) -> None:
    df = spark.createDataFrame([(1, "a b " * 200_000 + "tail"), (2, "x " * 3 + "a b " * 7)], "doc_id long, text string")
    assert result(remove_repeats(df)) == brute([(1, "a b " * 200_000 + "tail"), (2, "x " * 3 + "a b " * 7)], 13)
    assert remove_repeats(df.limit(0)).collect() == []


def test_memory_of_a_worker_is_bounded(monkeypatch) -> None:
    """What 16 MB of texts send to the groups, and a full group, take a fraction of what they took at once."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from ledgerline.llm import substrings

    steps = []
    frame = SimpleNamespace(select=lambda *a: frame, repartition=lambda *a: frame, sortWithinPartitions=lambda *a: frame)
    frame.mapInArrow = lambda f, schema: (steps.append(f), frame)[1]
    monkeypatch.setattr(substrings, "prefix_groups", lambda *a: ([np.arange(substrings.BINS) // 8192], 8))
    substrings.repeats(frame, 13, 50)
    local, below_prefix = steps
    drawn = np.random.default_rng(5).integers(0, 10**6, (2400, 1000))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(2400), "text": [" ".join(map(str, row)) for row in drawn.tolist()]})
    tracemalloc.start()
    sent = sum(sum(len(x) // 8 for x in out.column("hashes").to_pylist()) for out in local(iter([batch])))
    first = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent == 2400 * 988 and first < 150_000_000
    n, size = 16, substrings.GROUP // 16
    made = lambda i: {"part": 0, "docs": np.arange(i, i + 1).tobytes(), "counts": np.array([size], np.int32).tobytes(), "hashes": np.arange(size, dtype=np.uint64).tobytes()}
    tracemalloc.start()
    found = sum(sum(len(x) // 8 for x in out.column("hashes").to_pylist()) for out in below_prefix(pa.RecordBatch.from_pylist([made(i)], schema=substrings.SENT) for i in range(n)))
    second = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == (n - 1) * size and second < 130_000_000


def test_workers_get_small_batches(spark) -> None:
    """Rows reach workers 4 MB at a time unless the session says otherwise; by Spark's bound it was 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        df = spark.createDataFrame([(i, "x" * 1_000_000) for i in range(12)], "doc_id long, text string").coalesce(1)
        remove_repeats(df)
        sizes = df.mapInArrow(lambda batches: (b.select([0]).slice(0, 1) for b in batches), "doc_id long")
        assert sizes.count() >= 2
        spark.conf.set(key, "1m")
        remove_repeats(df)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_numbers_of_words_do_not_depend_on_pieces(monkeypatch) -> None:
    import numpy as np
    import pyarrow as pa

    from ledgerline.llm import words

    column = pa.array(["", None, "a  bc\n" * 50, " ", "long" * 40 + " x", "\u00e9 a"])
    whole = words.words_of(column, lower=False)
    monkeypatch.setattr(words, "PIECE", 7)
    cut = words.words_of(column, lower=False)
    assert np.array_equal(whole.hash, cut.hash) and np.array_equal(whole.first, cut.first)
