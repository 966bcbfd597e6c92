"""Rules of text quality per document, and a verdict per host that is joined back to documents.

Everything here is DataFrame operations: a document is measured within its own row, so that a host
with a third of all documents is no group of rows until counts are summed, which happens before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import count_up_to, staged

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a repeated window.
WINDOW = 5
#: A host below this rate never fails; a prior is worth at most so many documents; what is far above it.
MIN_RATE, MAX_WEIGHT, DEVIATIONS = 0.2, 100.0, 3.0
#: Host tables of at most so many rows are broadcast; others meet documents in a salted join.
BROADCAST_HOSTS, SALTS = 100_000, 64


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of each whole text.

    A null text counts as an empty one. Windows are compared by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({"_words": words(text), "_lines": lines, "_text": text})
    window = f"xxhash64({', '.join(f'_words[i + {j}]' for j in range(WINDOW))})"
    df = df.withColumns(
        {
            "_n": F.size("_words").cast("long"),
            "_windows": F.when(
                F.size("_words") >= WINDOW, F.expr(f"transform(sequence(0, size(_words) - {WINDOW}), i -> {window})")
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Most texts repeat nothing; only the others sort their windows.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    sorted_ = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(repeats, sorted_))
    twice = "x.h = get(_sorted, k - 1).h OR x.h = get(_sorted, k + 1).h"
    found = F.expr(f"sort_array(filter(transform(_sorted, (x, k) -> IF({twice}, x.i, NULL)), x -> x IS NOT NULL))")
    df = df.withColumn("_at", found)
    covered = F.expr(
        f"aggregate(transform(_at, (x, k) -> least({WINDOW}, coalesce(get(_at, k + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)"
    )
    return df.withColumns(
        {
            "n_words": F.col("_n"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).drop("_words", "_lines", "_text", "_n", "_windows", "_sorted", "_at")


def host_verdicts(judged: DataFrame, min_rate: float = MIN_RATE) -> DataFrame:
    """(host, n, failures, rate, rate_limit, host_failed) of each host of `judged` (host, rule_failed).

    Each host is held against a beta prior fitted by moments to all other hosts, so that one bad host
    does not widen the prior it is judged by. The prior's mean is the others' rate (half a failure in
    one more document added, as none seen is not none possible). Its weight, in documents, follows from
    how much more the others' rates vary than chance alone would make them, given each one's size, and
    lies between 1 and `MAX_WEIGHT`: few or even hosts do not make it certain. `rate` is the
    host's rate shrunk towards the mean by that weight. The host fails if it lies `DEVIATIONS` standard
    deviations of the prior above its mean, and above `min_rate`. A single host has nothing to be held
    against: its rate is null and it does not fail.
    """
    hosts = judged.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("rule_failed").cast("long")).cast("double").alias("failures")
    )
    hosts = staged(hosts, "hosts")
    square = F.col("failures") * F.col("failures") / F.col("n")
    all_, failed, squares, count = hosts.agg(F.sum("n"), F.sum("failures"), F.sum(square), F.count(F.lit(1))).first()
    others = F.nullif(F.lit(all_) - F.col("n"), F.lit(0.0))
    mean = (F.lit(failed) - F.col("failures") + 0.5) / (others + 1)
    hosts = hosts.withColumns({"_others": others, "_mean": mean, "_chance": mean * (1 - mean)})
    between = (F.lit(squares) - square) / F.col("_others") - F.col("_mean") * F.col("_mean") - F.col("_chance") * (count - 1) / F.col("_others")
    weight = F.when(between > 0, F.least(F.greatest(F.col("_chance") / between - 1, F.lit(1.0)), F.lit(MAX_WEIGHT))).otherwise(MAX_WEIGHT)
    hosts = hosts.withColumn("_weight", weight)
    rate = (F.col("failures") + F.col("_mean") * F.col("_weight")) / (F.col("n") + F.col("_weight"))
    limit = F.greatest(F.col("_mean") + DEVIATIONS * F.sqrt(F.col("_chance") / (F.col("_weight") + 1)), F.when(F.col("_mean").isNotNull(), min_rate))
    return hosts.select("host", "n", "failures", rate.alias("rate"), limit.alias("rate_limit"), (rate > limit).alias("host_failed"))


def judge(
    docs: DataFrame, min_rate: float = MIN_RATE, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source"
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, rule_failed, host_rate).

    A document fails the base with under 10 words, or if over a fifth of them stand in windows of five
    words that the text repeats. Failures of hosts count these documents and those with more than one
    symbol in ten words, with over 30 % of lines that repeat earlier ones, or with words of fewer than
    two characters on average. A document that passes the base is kept unless its host fails (see
    `host_verdicts`). Documents without a host have no host verdict and a null `host_rate`. Null texts
    are empty, repeated rows count each, other columns are ignored.
    """
    given = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{host_column}`").alias("host"), F.col(f"`{text_column}`").alias("text")
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    more = (10 * F.col("n_symbols") > F.col("n_words")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) | (F.col("word_chars") < 2 * F.col("n_words"))
    judged = staged(measured(given).drop("text").withColumns({"base_failed": failed, "rule_failed": failed | more}), "judged")
    verdicts = host_verdicts(judged, min_rate).select("host", F.col("rate").alias("host_rate"), "host_failed")
    if count_up_to(verdicts, BROADCAST_HOSTS) <= BROADCAST_HOSTS:
        joined = judged.join(F.broadcast(verdicts), "host", "left")
    else:
        salted = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
        joined = judged.withColumn("_salt", salt).join(salted, ["host", "_salt"], "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"),
        "n_lines", "rule_failed", "host_rate",
    )
