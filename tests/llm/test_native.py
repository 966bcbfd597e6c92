"""Rules, mixing and licences on small made tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import mixing, rules
from ledgerline.llm.licenses import KNOWN, known_licenses, scan_licenses
from ledgerline.llm.mixing import mix_sources, mixed
from ledgerline.llm.rules import judge, measured
from test_pipeline_llm import mix_brute


def rules_brute(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if n[g] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark, rng) -> None:
    texts = [None, "", " \n\t", "a", "é\x0b ü\x85x", "a b c d e a b c d e", "x " * 40, "l 1\nl 1\n\n\nl 1 ", "a|b <c> #", "a b c d e f " * 3]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 60))) for _ in range(80)] + ["\n".join(rng.choices(["p q", "r", "", " "], k=9)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in measured(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == rules_brute(texts[r.doc_id]), texts[r.doc_id]


def test_hosts_lose_their_documents_only_on_many_failures(spark, monkeypatch) -> None:
    fine, bad = " ".join(f"w{i}" for i in range(20)), "too short"
    rows = [(i, fine, "good") for i in range(300)] + [(1000 + i, bad if i < 95 else fine, "spam") for i in range(100)]
    rows += [(2000, bad, "small"), (2001, fine, "small"), (2002, fine, None), (2003, None, None), (2003, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("clash"))
    want = set(range(300))
    for limit in (100_000, 0):
        monkeypatch.setattr(rules, "BROADCAST_HOSTS", limit)
        got = judge(df).collect()
        assert len(got) == len(rows)
        kept = {r.doc_id for r in got if r.kept}
        assert kept == want | {2001, 2002}
        rates = {r.doc_id: r.host_rate for r in got}
        assert 0.5 < rates[1000] <= 0.95 and rates[2002] is None and 0 < rates[0] < 0.05 and rates[2000] < 0.5
    assert judge(df.limit(0)).collect() == []


def test_a_host_far_above_the_others_loses_its_documents(spark) -> None:
    """40 % against 8 %: lost, whatever its size beside the others. 8 %, 12 % and few documents: kept."""
    fine, bad = " ".join(f"w{i}" for i in range(20)), "too short"
    symbols = " ".join(["word # *"] + [f"w{i}" for i in range(10)])
    hosts = {"a": (1000, 80, bad), "b": (500, 40, bad), "c": (200, 24, bad), "far": (1000, 400, bad), "few": (5, 2, bad)}
    for changed, lost in ({}, {"far"}), ({"far": (100, 40, bad)}, {"far"}), ({"far": (1000, 400, symbols)}, {"far"}), ({"far": (1000, 90, bad)}, set()):
        given = hosts | changed
        rows = [(text if i < failed else fine, host) for host, (n, failed, text) in given.items() for i in range(n)]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string")
        got = judge(df).collect()
        assert {rows[r.doc_id][1] for r in got if not r.base_failed and not r.kept} == lost
        assert all(r.rule_failed == (rows[r.doc_id][0] != fine) for r in got)
    one = spark.createDataFrame([(1, fine, "x"), (2, bad, "x"), (3, bad, "x")], "doc_id long, text string, source string")
    assert {(r.doc_id, r.kept, r.host_rate) for r in judge(one).collect()} == {(1, True, None), (2, False, None), (3, False, None)}


def test_mix_equals_its_definition(spark, rng, monkeypatch) -> None:
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "a", "a", "b", "c", "Z", "é", None])) for i in range(400)]
    rows += [(5, "x y", "tiny"), (None, "x y z", "tiny"), (7, None, "none"), (8, "v " * 3000, "long"), (9, "v", "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    for limit in (100_000, 0):
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
        got = mix_sources(df).collect()
        assert len(got) == len(rows)
        want = mix_brute(rows)
        times = Counter()
        for r in got:
            assert r.taken <= 3 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
            if r.size:
                times[r.doc_id] += r.taken // r.size
        assert +times == want
        assert Counter(r.doc_id for r in mixed(df).collect()) == want
    assert mixed(df).columns == df.columns
    assert mix_sources(df.limit(0)).collect() == [] and mixed(df.limit(0)).collect() == []


def test_licences(spark) -> None:
    mit = KNOWN[0][1]
    rows = [
        (1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ")), (3, mit + " changed"),
        (4, "text\nReleased under the MIT Licence!\nmore\nlicensed  under CC BY-NC 4.0"), (5, None), (6, ""), (7, "Copyright 2020 X"), (1, mit),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("license_id", F.lit("clash"))
    got = sorted((r.doc_id, r.license_id, r.notices) for r in scan_licenses(df, known_licenses(spark)).collect())
    assert [g for g in got if g[0] in (1, 2)] == [(1, "MIT", None), (1, "MIT", None), (2, "MIT", None)]
    assert [g[1:] for g in got if g[0] > 2] == [(None, None), (None, "CC-BY-NC-4.0,MIT"), (None, None), (None, None), (None, None)]
    two = spark.createDataFrame([("B", "x"), ("A", "X."), (None, "x"), ("C", None)], "license_id string, text string")
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert [r.license_id for r in scan_licenses(one, two).collect()] == ["A"]
    assert scan_licenses(one.limit(0), two).collect() == []


def test_full_texts_of_common_licences(spark) -> None:
    """Entire texts under other copyright lines, wrapped and spelled otherwise, name their licence."""
    from ledgerline.llm.licenses import MIT, TEXTS

    texts = {f.name.removesuffix(".txt"): f.read_text() for f in TEXTS.iterdir()}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "Unlicense", "Zlib"} <= set(texts)
    rows = [(name, text) for name, text in texts.items()] + [(name, " ".join(text.split())) for name, text in texts.items() if "Copyright" not in text]
    rows += [("MIT", f"{line}\n\n{MIT}") for line in ("Copyright (c) <year> <holders>", "Copyright Jane Doe", "Copyright The Foo Authors 2019", "COPYRIGHT JANE DOE", "© Jane Doe")]
    rows += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2019, Jane Doe\nAll rights reserved.\n\n" + texts["BSD-3-Clause"])]
    rows += [("GPL-2.0", texts["GPL-2.0"].split("END OF TERMS")[0]), ("Apache-2.0", texts["Apache-2.0"].replace("license", "licence"))]
    rows += [(None, texts["Apache-2.0"].replace("(c) You must retain", "(c) You may drop")), (None, "COPYRIGHT HOLDERS BE LIABLE\n" + MIT)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in scan_licenses(df, known_licenses(spark)).collect()}
    assert [(got[i], t[:60]) for i, (_, t) in enumerate(rows)] == [(name, t[:60]) for name, t in rows]


def test_spellings_are_whole_words(spark) -> None:
    from ledgerline.llm.licenses import canonical

    pairs = [("we fulfil it", "we fulfill it"), ("sub licences", "sublicenses"), ("unrecognised", "unrecognized"), ("a licensee", "a licensee"), ("epicentre", "epicentre")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(canonical(F.col("a")).alias("a"), F.col("b")).collect()
    assert [r.a for r in got] == [r.b.replace(" ", "") for r in got]
    assert df.select(canonical(F.col("b")).alias("b")).first().b == "wefulfillit"
