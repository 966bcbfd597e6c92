"""From raw documents to packed training sequences, in stages that each write a table.

A document whose lines look bad goes; of near duplicates one stays; word sequences that an earlier
document has are cut; sources are mixed to target weights; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import crf
from ledgerline.llm.jaccard import Similarity, near_duplicates
from ledgerline.llm.mixing import mixed
from ledgerline.llm.packing import pack
from ledgerline.llm.queries import GOOD, TOKENIZERS, quality_model
from ledgerline.llm.substrings import remove_repeats
from ledgerline.llm.tables import OWN_COLUMNS, rows_without, staged, table


def apart(docs: DataFrame, names: set[str]) -> dict[str, str]:
    """What to call each column of `docs` while an operator uses `names`: itself unless it is one of them."""
    called = {c: c for c in docs.columns}
    for c in names.intersection(docs.columns):
        while called[c] in names or called[c] in docs.columns:
            called[c] = f"own_{called[c]}"
    return called


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good; it learns from the labels of the corpus.

    A null or empty text is one empty line. Rows that repeat are judged each, null ids like others. All
    columns pass through as they are, one named `score` too. An empty table stays empty.
    """
    own = apart(docs, {"score"})
    scored = crf.score(docs.withColumnsRenamed(own), quality_model(spark, sf_dir)).where(F.col("score") >= GOOD)
    return scored.select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows are told apart by file and place within it, so that of rows that repeat an id one stays as well,
    however the files are dealt out to tasks when the table is read again. Documents that come from no
    file are written to one first. A row with a null id comes last; a text without words is like no
    other. All columns pass through, whatever their names. An empty table stays empty.
    """
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["file_path"])
    except AnalysisException:
        docs = staged(docs, "near-copies")
        place = docs.metadataColumn("_metadata")
    own = apart(docs, {"_file", "_row", *OWN_COLUMNS})
    placed = docs.select(
        *[F.col(f"`{c}`").alias(new) for c, new in own.items()],
        F.xxhash64(place["file_path"]).alias("_file"),
        place["row_index"].alias("_row"),
    )
    name = F.struct(F.col("doc_id").isNull(), "doc_id", "_file", "_row")
    found = near_duplicates(placed.select(name.alias("name"), "text"), Similarity(5, 80, 100), "name", "text", count_links=False)
    gone = staged(found.where("doc_id != component_id").select("doc_id._file", "doc_id._row"), "copies")
    kept = rows_without(placed, gone, ["_file", "_row"])
    return kept.select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the sequences of 13 words that a document with a smaller id has.

    `n_chars`, where there is such a column, follows the text (null if that is). A null id counts as the
    largest, rows that share an id do not cut each other; all other columns pass through, whatever
    their names. An empty table stays empty.
    """
    own = apart(docs, {"n_words", "n_removed", "removed", "kept_sha256"})
    cut = remove_repeats(docs.withColumnsRenamed(own), 13)
    cut = cut.select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Texts without words are never taken; a null source is a source. All columns pass through, whatever
    their names. An empty table stays empty.
    """
    return mixed(docs, (5, 2, 1))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens.

    A null text is an empty one and gives one piece; rows that repeat are packed each. Only `doc_id` and
    `text` are looked at. An empty table gives no pieces.
    """
    return pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", substrings),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: The classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
