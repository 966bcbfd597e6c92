"""Prefix dynamic programming against the tokenizers library, and round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import bpe
from ledgerline.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def ids(found) -> bytes:
    return np.array(found, dtype="<u4").tobytes()


def samples(vocabulary) -> list[str]:
    rng = random.Random(3)
    letters = "aAbeintrs 'stdlm\n\t  é中🙂0123.,!?-_Ᲊ꟎՘"
    tokens = list(vocabulary.bytes.values())
    out = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    out += ["a" * k for k in range(1, 120)] + ["".join(rng.choices("ab", k=150)) for _ in range(300)]
    out += [b"".join(rng.choices(tokens, k=10)).decode("utf-8", "ignore") for _ in range(3000)]
    out += ["".join(map(chr, rng.choices(range(1, 0xD800), k=20))) for _ in range(1000)]
    return [*out, "", "<|endoftext|>", " <|endoftext|><|endoftext|>  x", "it's we'll I'M", "\n\n  \n x"]


def test_ids_are_those_of_the_library(library, vocabulary):
    texts = samples(vocabulary)
    expected = [ids(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    found = bpe.Encoder(vocabulary)(texts)
    assert [t for t, a, b in zip(texts, found, expected) if a != b] == []
    assert [bpe.decode(x, vocabulary.bytes) for x in found] == texts


def test_characters_split_as_in_the_library(library, vocabulary):
    encoder, split = bpe.Encoder(vocabulary), library.pre_tokenizer.pre_tokenize_str
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000, 7), 0x2EBF0, 0x323B0]):
        text = f"a{c}1{c}.{c} {c}{c}\n{c} b"
        assert encoder.pieces(text) == [text[a:b] for _, (a, b) in split(text)], hex(ord(c))


def test_each_prefix_has_one_last_token(library, vocabulary):
    """The table entry of a prefix is the last token of that prefix encoded alone, and no other token fits."""
    for word in ("unbelievable", "aaaaaaaaab", "incontrovertibly", "xyzzyxyzzy"):
        for end in range(1, len(word) + 1):
            whole = library.encode(word[:end], add_special_tokens=False).ids
            assert next(vocabulary.encode_pieces([word[:end].encode()])) == ids(whole)
            if len(whole) > 1:
                assert vocabulary.fit(whole[-2], whole[-1])


def test_small_caches_and_parts_change_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 16)
    monkeypatch.setattr(bpe, "PART", 32)
    texts = [*samples(vocabulary)[:400], "word " * 300, "x" * 500, "  \n " * 100, "a<|endoftext|>b " * 30]
    vocabulary.fitting.clear()
    assert bpe.Encoder(vocabulary)(texts) == [ids(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_broken_and_unknown_ids(library, vocabulary):
    for numbers in ([169], [169, 253], [220, 169, 253, 123, 64], [50256, 64, 169], [99, 10**6, 100]):
        assert bpe.decode(ids(numbers), vocabulary.bytes) == library.decode(numbers, skip_special_tokens=False)


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulary(f"{TOKENIZERS}/word_bpe_49k.json")


def test_rows(spark, library):
    """Null and empty texts have no ids; repeated rows, null ids, long texts and clashing names are kept."""
    long_text = "naïve words, 12 of them. " * 40_000
    rows = [(1, "Hello world"), (1, "Hello world"), (None, "x"), (2, None), (3, ""), (4, long_text), (5, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"ids": F.lit("mine"), "n_tokens": F.lit(0), "id": F.lit(1), "_ids": F.lit(2)})
    encoded = bpe.encode_texts(docs, PATH)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    decoded = bpe.decode_ids(encoded, PATH).collect()
    expected = [(i, ids(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, bytes(r.ids), r.text) for r in decoded], key=key) == sorted(expected, key=key)
    assert all(r.n_tokens == len(r.ids) // 4 for r in decoded)
    assert bpe.encode_texts(docs.limit(0), PATH).count() == 0


def test_query_on_the_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for r in docs:
        found = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(found, skip_special_tokens=False)
        expected.add((r.doc_id, len(found), hashlib.sha256(ids(found)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    found = QUERIES["op11_bpe_round_trip"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(found) == len(docs) and set(map(tuple, found)) == expected
