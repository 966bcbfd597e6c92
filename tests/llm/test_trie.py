"""The trie against one made of nested dictionaries, in one shard and in many."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=600))
def test_closing_parentheses(choices) -> None:
    bits, deep = [1], 1
    for up in choices:
        bits.append(int(up or deep == 1))
        deep += 1 if bits[-1] else -1
    bits += [0] * deep
    held, closes = [], {}
    for i, b in enumerate(bits):
        if b:
            held.append(i)
        else:
            closes[held.pop()] = i
    pairs = trie.Parentheses(np.array(bits, dtype=bool))
    opens = np.flatnonzero(pairs.bits)
    assert pairs.find_close(opens).tolist() == [closes[i] for i in opens.tolist()]
    assert pairs.rank(opens).tolist() == list(range(len(opens)))


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + t[h:]
    return out


def expected(convs: dict[int, list]) -> list[tuple]:
    members: dict[tuple, list] = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        children = sum(len(p) == len(path) + 1 for p in below)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), children, len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def found(spark, rows) -> list[tuple]:
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit(1), "sizes": F.lit(2), "shard": F.lit(3), "own": F.lit("x")})
    return sorted(map(tuple, trie.prefix_trie(trie.sequences(table)).collect()))


def talk(rng: random.Random, convs: int) -> list[tuple]:
    texts = ["hi", "no", "ä🙂", ""]
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(texts)) for c in rng.sample(range(-250, 1000), convs) for t in range(rng.randrange(1, 9))]


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_equals_nested_dictionaries(spark, rng, monkeypatch, shards) -> None:
    """Common beginnings, copies, nulls, repeated rows and turn numbers, and conversations without turns."""
    rows = talk(rng, 150)
    rows += [(5000 + i, t, "user", "same") for i in range(60) for t in range(3)]  # copies that span shards
    rows += [(6000 + i, t, "user", "same") for i in range(40) for t in range(7)]  # and go on
    rows += [(7100 + i, 0, "user", "gone") for i in range(30)]  # some lose all their turns
    rows += [(8000, None, None, None), (8000, None, None, None), (8000, 1, "a", None), (8000, 1, "b", "x"), (None, 1, "user", "hi")]
    monkeypatch.setattr(trie, "CHUNK", 3)
    monkeypatch.setattr(trie, "MOST", sum(1 for _ in rows) // shards)
    convs = rebuilt(rows)
    assert any(not t for t in convs.values())
    assert found(spark, rows) == expected(convs)


def test_copies_only_and_very_long(spark, monkeypatch) -> None:
    monkeypatch.setattr(trie, "MOST", 50)
    rows = [(100 * c, t, "user", "same" * 1000) for c in range(1, 40) for t in range(4)]
    assert found(spark, rows) == expected(rebuilt(rows))
    rows = [(0, t, "user", f"turn {t}") for t in range(300)] + [(100, t, "user", f"turn {t}") for t in range(200)]
    assert found(spark, rows) == expected(rebuilt(rows))


def test_no_rows_and_no_turns(spark) -> None:
    assert found(spark, []) == []
    lost = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6)
    nothing = hashlib.sha256(str(lost).encode()).hexdigest()
    assert found(spark, [(lost, 0, "user", "x")]) == [(lost, 0, None, 1, 0, 1, 0, nothing)]
