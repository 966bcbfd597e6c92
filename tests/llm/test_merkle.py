"""Manifests against a tree built plainly, and proofs that fail for what was changed."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    values = [None if v is None else str(v) for v in row]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in (values[0], values[1], values[2], values[3], values[4])))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of a list, and the siblings of each of its nodes."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            path.append((nodes[i - 1], "") if i % 2 else ("", nodes[i + 1] if i + 1 < len(nodes) else ""))
        nodes, at = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return nodes[0], paths


def expected(rows) -> list[tuple]:
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subroots, found = [], []
    for name in order:
        members = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subroot, paths = climb([leaf(r) for r in members])
        subroots.append(subroot)
        found.append((members, paths))
    root, tops = climb(subroots)
    out = []
    for (members, paths), subroot, top in zip(found, subroots, tops):
        out += [(r[0], leaf(r), subroot, root, tuple(p + top)) for r, p in zip(members, paths)]
    return out


def built(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"_tree": F.lit(1), "leaf": F.lit("x"), "siblings": F.lit(2)})
    found = merkle.manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "siblings"]
    return [(r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.siblings))) for r in found.collect()]


def key(r):
    return r[0] is not None, r[0] or 0, r[1], r[4]


def corpus(rng: random.Random, n: int, langs) -> list[tuple]:
    texts = ["", None, "é" * 50, "x" * 3000, "12:a"]
    return [(i, rng.choice(["a", None, "b"]), rng.choice(langs), rng.choice([None, 0, i]), rng.choice(texts)) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100])
def test_equals_a_plain_tree(spark, rng, monkeypatch, n) -> None:
    """With blocks of four, trees of several rounds; nulls, repeated rows and one large tree included."""
    monkeypatch.setattr(merkle, "BITS", 2)
    rows = corpus(rng, n, ["de", "en", "en", "en", None, "é", ""])
    rows += rows[:2] * 2 + [(None, None, None, None, None), (None, "a", None, 3, "y"), (rows[0][0], "z", rows[0][2], 1, "other")]
    assert sorted(built(spark, rows), key=key) == sorted(expected(rows), key=key)


def test_whole_blocks_and_many_trees(spark, rng) -> None:
    rows = corpus(rng, 700, ["en"]) + [(10_000 + i, None, f"l{i:03}", 1, "t") for i in range(40)]
    assert sorted(built(spark, rows), key=key) == sorted(expected(rows), key=key)


def test_no_rows(spark) -> None:
    assert built(spark, []) == []


def test_one_row_is_its_own_root(spark) -> None:
    [(_, own, subroot, root, siblings)] = built(spark, [(7, "a", "en", 1, "x")])
    assert own == subroot == root and siblings == ()


def test_values_do_not_run_into_each_other(spark) -> None:
    rows = [(1, "a", "b", 1, "c"), (1, "a1:b", None, 1, "c"), (1, None, "b", 1, "c"), (1, "-", "b", 1, "c"), (1, "", "b", 1, "c")]
    assert len({r[1] for r in built(spark, rows)}) == len(rows)


def test_only_changed_rows_fail(spark, rng) -> None:
    rows = corpus(rng, 60, ["en", "de"])
    docs = spark.createDataFrame(rows, SCHEMA)
    shown = merkle.digest_of(*[F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    found = merkle.manifest(docs, carried={"shown": shown}).select("doc_id", (merkle.folded("shown") == F.col("root")).alias("ok")).collect()
    changed = {r[0] for r in rows if r[0] % 3 == 0 and r[3] is not None}
    assert {r.doc_id for r in found if not r.ok} == changed and len(found) == len(rows)
