"""The Jaccard join against all pairs."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm.jaccard import Similarity, near_duplicates, shingle_sets, signatures

LIKE = Similarity(4, 85, 100)


def shingles(text: str | None, k: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*[w[i:] for i in range(k)]))


def brute(rows: list[tuple[int | None, str | None]], like: Similarity) -> list[tuple]:
    sets = [shingles(t, like.k) for _, t in rows]
    group = list(range(len(rows)))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and like.linked(set(sets[i]), set(sets[j])):
            group[root(i)] = root(j)
    least: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least.setdefault(root(i), []).append(doc)
    return sorted(((d, len(sets[i]), min(least.get(root(i), [None]))) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(rng: random.Random, groups: int, lengths: tuple[int, int]) -> list[str]:
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(*lengths))
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [copy[at], "new"]])
            out.append(rng.choice([" ", "\n", "  "]).join(copy))
    return out


def result(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("like", [LIKE, Similarity(5, 80, 100)])
def test_equals_all_pairs(spark, rng, like) -> None:
    texts = near_copies(rng, 60, (3, 20)) + near_copies(rng, 30, (40, 300))
    texts += [None, "", " \n", "A b", "a B", "a b c", "x " * 500]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(near_duplicates(df, like)) == brute(rows, like)


def test_every_linked_pair_shares_a_signature(rng) -> None:
    import pyarrow as pa

    texts = near_copies(rng, 150, (5, 40)) + near_copies(rng, 20, (500, 900))
    for like in (LIKE, Similarity(3, 70, 100)):
        hashes, sizes = shingle_sets(pa.array(texts), like.k)
        sigs, whose = signatures(hashes, sizes, like)
        of = [set(sigs[whose == i].tolist()) for i in range(len(texts))]
        sets = [shingles(t, like.k) for t in texts]
        assert [len(s) for s in sets] == sizes.tolist()
        for i, j in itertools.combinations(range(len(texts)), 2):
            if sets[i] != sets[j] and like.linked(set(sets[i]), set(sets[j])):
                assert of[i] & of[j]


def test_sets_with_empty_segments_meet_under_another_hash(monkeypatch, rng) -> None:
    """Without deletions most sets lack segments; pairs must be found all the same."""
    import pyarrow as pa

    from ledgerline.llm import jaccard

    monkeypatch.setattr(jaccard, "allocate", lambda size, segments: 0)
    jaccard.MADE.clear()
    for seeds in (6, 1):
        monkeypatch.setattr(jaccard, "SEEDS", seeds)
        texts = near_copies(rng, 120, (8, 60))
        hashes, sizes = shingle_sets(pa.array(texts), 4)
        sigs, whose = signatures(hashes, sizes, LIKE)
        of = [set(sigs[whose == i].tolist()) for i in range(len(texts))]
        sets = [shingles(t, 4) for t in texts]
        for i, j in itertools.combinations(range(len(texts)), 2):
            if sets[i] != sets[j] and LIKE.linked(set(sets[i]), set(sets[j])):
                assert of[i] & of[j]
    jaccard.MADE.clear()


def test_sketches_never_differ_more_than_sets(rng) -> None:
    import pyarrow as pa

    from ledgerline.llm.jaccard import parities

    texts = near_copies(rng, 20, (5, 600))
    hashes, sizes = shingle_sets(pa.array(texts), 4)
    words = np.stack(parities(hashes, sizes), axis=1)
    sets = [shingles(t, 4) for t in texts]
    close = []
    for i, j in itertools.combinations(range(len(texts)), 2):
        bits, apart = int(np.bitwise_count(words[i] ^ words[j]).sum()), len(sets[i] ^ sets[j])
        assert bits <= apart
        if apart <= 60:
            close.append((bits, apart))
    assert sum(b for b, _ in close) > 0.8 * sum(a for _, a in close) > 0


def test_a_large_group_of_loose_copies(spark, rng, monkeypatch) -> None:
    """Copies that share signatures and mostly do not link, resolved over several rounds."""
    from ledgerline.llm import jaccard

    monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", 0)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(90):
        copy = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 4, 5, 6])):
            copy[at] = f"x{i}-{at}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(near_duplicates(df, LIKE)) == brute(rows, LIKE)


def test_chain_of_links_and_repeated_rows(spark) -> None:
    words = [f"v{i}" for i in range(120)]
    texts = []
    for i in range(12):  # each a little further from the first
        words[i * 9] = f"changed{i}"
        texts.append(" ".join(words))
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (7, texts[3]), (None, texts[2]), (None, "alone"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, LIKE)) == brute(rows, LIKE)


def test_empty_table_and_other_columns(spark) -> None:
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).collect() == []
    odd = spark.createDataFrame([("a", "x y z", 1, 2), ("b", "x y z", 3, 4)], "key string, body string, node int, sig int")
    rows = near_duplicates(odd, LIKE, "key", "body").collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [("a", "a"), ("b", "a")]


def test_kernel_counts_shingles_once() -> None:
    import pyarrow as pa

    hashes, sizes = shingle_sets(pa.array(["a b c d a b c d a b c d", "", None, "q"]), 4)
    assert sizes.tolist() == [4, 0, 0, 1]
    assert len(np.unique(hashes)) == 5


def link_brute(rows: list[tuple[int | None, str | None]], like: Similarity) -> list[tuple]:
    sets = [set(shingles(t, like.k)) for _, t in rows]
    n = [sum(bool(a and b and i != j and like.linked(a, b)) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    return sorted(((d, n[i]) for i, (d, _) in enumerate(rows)), key=str)


def test_links_are_counted_whatever_the_rounds(spark, rng, monkeypatch) -> None:
    """A group of mutual near copies, exact copies, a loose group; blocks of any size give the same."""
    from ledgerline.llm import jaccard

    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(0, 200, 4)]  # all link with all
    texts += near_copies(rng, 25, (3, 120)) + ["same text here twice"] * 3 + [None, "", "alone"]
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(200), rng.choice([1, 4, 8, 10])):
            copy[at] = f"y{i}-{at}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts)) + [(None, texts[0]), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = link_brute(rows, LIKE)
    for block, columns in ((256, 4096), (7, 13)):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "COLUMNS", columns)
        got = near_duplicates(df, LIKE).collect()
        assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == want


def test_cells_never_differ_more_than_sets(rng) -> None:
    from ledgerline.llm.jaccard import cells_of, least_difference

    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=3000)
    near = [*base[:1400], "x", *base[1401:]]
    texts = [" ".join(w) for w in (base, near, base[:700], rng.choices(words, k=3000), rng.choices(words, k=40), ["one"])]
    hashes, sizes = shingle_sets(pa.array(texts), 4)
    sets = [set(x.tolist()) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
    cells = cells_of(hashes, sizes)
    for i, j in itertools.product(range(len(texts)), repeat=2):
        assert least_difference(cells[i], cells[j]) <= len(sets[i] ^ sets[j])
    assert least_difference(cells[0], cells[1]) > 0
    # Long texts that share nothing are told apart without their texts, which 512 cells cannot do.
    assert least_difference(cells[0], cells[3]) > LIKE.differ(sizes[0], sizes[3])


def test_texts_are_moved_for_likely_pairs_only(spark, monkeypatch) -> None:
    """Long texts that share a line but little else meet in buckets; none of their texts is fetched."""
    from ledgerline.llm import jaccard

    fetched = []
    kept = jaccard._texts
    monkeypatch.setattr(jaccard, "_texts", lambda *a: fetched.append(out := kept(*a)) or out)
    monkeypatch.setattr(jaccard, "forget", lambda *tables: None)
    line = " ".join(f"shared{i}" for i in range(300))
    rows = [(i, line + " " + " ".join(f"t{i}x{j}" for j in range(1500))) for i in range(20)]
    rows += [(20, "a b c d e f g h " * 3 + "z"), (21, "a b c d e f g h " * 3 + "z y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, LIKE, count_links=False).collect()}
    assert found == {**{i: i for i in range(21)}, 21: 20}
    assert sum(df.count() for df in fetched) == 2
