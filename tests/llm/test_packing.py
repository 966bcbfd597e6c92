"""Packing: ids equal the tokenizer's, sequences are gapless, and few."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm.packing import OpenBins, pack, text_parts, word_tokens

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text: str) -> bytes:
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_give_the_ids_of_the_text(text) -> None:
    from tokenizers import Tokenizer

    global _tokenizer
    if "_tokenizer" not in globals():
        _tokenizer = (Tokenizer.from_file(PATH), word_tokens(PATH))
    text = text.encode("utf-8", "ignore").decode()
    own = _tokenizer[1]([text.encode()])[0]
    assert own == np.array(_tokenizer[0].encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_special_strings_and_long_texts(tokenizer) -> None:
    own = word_tokens(PATH)
    for text in ("a<|endoftext|>B", "<|ENDOFTEXT|> It's IT'S x", "é é   İ ǅ", "word " * 300_000):
        parts = list(text_parts(text.encode(), 100))
        assert b"".join(parts) == text.encode() and (len(parts) > 1 or len(text) < 200)
        assert b"".join((*own(parts), bytes(4))) == ids_of(tokenizer, text)


def check(rows, texts, tokenizer, capacity) -> int:
    whole: dict[int, list] = {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append(r)
    fill: dict[int, list] = {}
    for doc, text in texts:
        ids = ids_of(tokenizer, text or "")
        got = sorted(whole.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        at = 0
        for r in got:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            assert r.length == capacity or r is got[-1]
            at += r.length
            fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert 4 * at == len(ids)
    assert not whole
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(fill)


def test_whole_tables(spark, sf, tokenizer) -> None:
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = pack(docs, PATH).collect()
    made = check(rows, texts, tokenizer, 2048)
    least = -(-sum(r.length for r in rows) // 2048)
    assert made <= least * 1.03 + 1


def test_nulls_repeats_ties_and_empty_table(spark, tokenizer) -> None:
    texts = [(1, None), (2, ""), (3, "same text"), (4, "same text"), (5, "x " * 100), (6, "y " * 15)]
    df = spark.createDataFrame([(d, t, 9) for d, t in texts], "doc_id long, text string, piece int")
    check(pack(df, PATH, capacity=16).collect(), texts, tokenizer, 16)
    assert pack(df.limit(0), PATH).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r.length for r in pack(twice, PATH).collect()) == [1, 3, 3]


def test_bins_close_the_fullest_first() -> None:
    bins = OpenBins(10, 2)
    assert bins.place(6, ("a",)) == [] and bins.place(7, ("b",)) == []
    closed = bins.place(8, ("c",))
    assert [r[0] for r in closed] == ["b"]
    assert [r[0] for r in bins.place(4, ("d",))] == ["a", "d"]
    rng = random.Random(1)
    bins = OpenBins(100, 16)
    done = []
    for i in range(5000):
        done += bins.place(rng.randint(1, 100), (i,))
        assert bins.open <= 16
    done += [r for rest in bins.rest() for r in rest]
    assert sorted(r[0] for r in done) == list(range(5000))
