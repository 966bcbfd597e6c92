"""The pipeline stage by stage against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from test_jaccard import brute as jaccard_brute
from test_packing import PATH, check
from test_substrings import brute as substring_brute

from ledgerline.llm.jaccard import Similarity
from ledgerline.llm.queries import GOOD, op10_line_crf_quality


def mix_brute(rows):
    """Copies of each document, by the definition of the mix."""
    size = lambda t: len((t or "").encode().split())
    h = lambda d: int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16)
    total = Counter()
    for d, t, s in rows:
        total[s] += size(t)
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        share = (sum(total.values()) - sum(3 * total[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        more = {s for s in names if s not in full and 3 * total[s] < share * weight[s]}
        if not more:
            break
        full |= more
    out = Counter()
    for s in names:
        target = 3 * total[s] if s in full else share * weight[s]
        times = int(target // total[s]) if total[s] else 0
        budget, below, cut = target - times * total[s], 0, 0
        sums = Counter()
        for d, t, x in rows:
            if x == s:
                sums[h(d)] += size(t)
        for key in sorted(k for k in sums if sums[k]):
            if below + sums[key] > budget:
                cut = key + (below + sums[key] - budget < budget - below)
                break
            below += sums[key]
        for d, t, x in rows:
            if x == s and size(t):
                out[d] += times + (h(d) < cut)
    return +out


@pytest.fixture(scope="module")
def steps(spark):
    sf = "/root/testdata/sf0.001"
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.staged(stage(spark, docs[-1], sf), "test"))
    return docs


def test_stages_against_brute_force(spark, steps) -> None:
    sf = "/root/testdata/sf0.001"
    raw, good, single, cut, mixed, packed = ([r for r in d.collect()] for d in steps)
    assert all(d.columns == steps[0].columns for d in steps[:5])
    scores = {r.doc_id: r.score for r in op10_line_crf_quality(spark, sf).collect()}
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in raw if scores[r.doc_id] >= GOOD)
    groups = jaccard_brute([(r.doc_id, r.text) for r in good], Similarity(5, 80, 100))
    assert sorted(r.doc_id for r in single) == sorted(d for d, _, c in groups if d == c)
    want = {d: (n - gone, sha) for d, n, gone, sha in substring_brute([(r.doc_id, r.text) for r in single], 13)}
    assert len(cut) == len(single)
    for r in cut:
        words = r.text.encode().split()
        assert want[r.doc_id] == (len(words), hashlib.sha256(b" ".join(words)).hexdigest()) and r.n_chars == len(r.text)
    assert Counter(r.doc_id for r in mixed) == mix_brute([(r.doc_id, r.text, r.source) for r in cut])
    texts = {r.doc_id: r.text for r in mixed}
    first = {}
    for r in packed:
        first.setdefault((r.doc_id, r.piece), r)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert {d for d, _ in first} == set(texts)


def test_run_equals_its_stages(spark, steps) -> None:
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "piece", "length", "ids_crc32").collect()
    assert Counter(map(tuple, got)) == Counter(tuple(r)[:2] + (r.length, r.ids_crc32) for r in steps[-1].collect())


def test_empty_and_odd_tables(spark, steps, tmp_path) -> None:
    sf = "/root/testdata/sf0.001"
    docs = steps[0]
    for odd in (docs.limit(0), spark.createDataFrame([(1, None, None, None, None), (None, "", "en", None, 0), (None, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5)], docs.schema)):
        for name, stage in corpus_pipeline.STAGES:
            assert corpus_pipeline.staged(stage(spark, odd, sf), "odd").count() >= 0
    rows = corpus_pipeline.near_copies(spark, odd, sf).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == ["1", "2", "None"]
    assert check and PATH


CLASHING = {"score": 7.5, "_row": "mine", "_file": "f", "_name": 1, "n_words": -1, "n_removed": -2, "removed": "r", "kept_sha256": "k", "own_score": 8, "rest": 9, "_metadata": "m", "size": 3, "h": 4, "row": 5}


def test_clashing_names_pass_through(spark, steps) -> None:
    """Columns that carry the operators' own names keep their values, with and without `n_chars`."""
    sf = "/root/testdata/sf0.001"
    plain = steps[0]
    extra = plain.select("*", *[corpus_pipeline.F.lit(v).alias(k) for k, v in CLASHING.items()]).drop("n_chars")
    for (name, stage), after in zip(corpus_pipeline.STAGES[:4], steps[1:5]):
        extra = corpus_pipeline.staged(stage(spark, extra, sf), "extra")
        assert set(extra.columns) == (set(plain.columns) | set(CLASHING)) - {"n_chars"}, name
        assert sorted(r.doc_id for r in extra.collect()) == sorted(r.doc_id for r in after.collect()), name
        assert [tuple(r) for r in extra.select(*CLASHING).distinct().collect()] == [tuple(CLASHING.values())], name


def test_near_copies_stand_when_files_are_dealt_out_anew(spark, steps, tmp_path) -> None:
    """Files packed into other partitions between the call and the action give the same rows."""
    path = str(tmp_path / "docs")
    steps[1].repartition(7).write.parquet(path)
    want = sorted(r.doc_id for r in steps[2].collect())
    settings = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(s, None) for s in settings]
    try:
        spark.conf.set(settings[0], "7")
        kept = corpus_pipeline.near_copies(spark, spark.read.parquet(path), "")
        spark.conf.set(settings[0], "1")
        spark.conf.set(settings[1], "1")
        spark.conf.set(settings[2], "10000")
        assert sorted(r.doc_id for r in kept.collect()) == want
    finally:
        for s, v in zip(settings, before):
            spark.conf.unset(s) if v is None else spark.conf.set(s, v)
