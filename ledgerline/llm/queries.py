"""One query for each operator of this package, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf
from .bpe import decode_ids, encode_texts
from .html import extract
from .jaccard import Similarity, near_duplicates
from .licenses import known_licenses, scan_licenses
from .lm import crc_text, score_texts
from .merkle import FIELDS, digest_of, folded, manifest, proof_text
from .mixing import mix_sources
from .packing import pack
from .rules import judge
from .substrings import remove_repeats
from .tables import table
from .topk import top_k
from .trie import prefix_trie, sequences

#: Where the vocabulary files of the public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Similarity(4, 85, 100))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"), 13)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("host_rate")


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), (5, 2, 1))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), F.coalesce(crc_text("doc_id") % 7 != 2, F.lit(True)))


def quality_model(spark: SparkSession, sf_dir: str) -> crf.Model | None:
    """Learns from labels outside the fifth that is held out."""
    return crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_text("doc_id") % 5 != 0)


#: Scores from here on count as label 1.
GOOD = 0.3


@query
def op10_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = crf.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    held_out = F.coalesce(crc_text("doc_id") % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query
def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    decoded = decode_ids(encode_texts(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and what its proofs say when every seventh row or so has another length noted."""
    tampered = F.when(F.coalesce(crc_text("doc_id") % 7 == 0, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    shown = digest_of(*[tampered if c == "n_chars" else F.col(c) for c in FIELDS])
    rows = manifest(table(spark, sf_dir, "documents"), carried={"shown": shown})
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(), 256).alias("proof_sha256"), folded("shown").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(sequences(table(spark, sf_dir, "conversations")))
