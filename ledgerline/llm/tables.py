"""Reading the input tables, and tables kept between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.paths import remove

#: White space between words: space and the characters 9 to 13.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared folder and read back: later steps recompute nothing of it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def forget(*tables: DataFrame) -> None:
    """Removes staged tables whose consumers have all been written; other DataFrames are passed over."""
    for df in tables:
        path = getattr(df, "_staged_at", None)
        if path:
            remove(df.sparkSession, path)


def count_up_to(df: DataFrame, most: int) -> int:
    """Number of rows, counted no further than `most` + 1."""
    return df.limit(most + 1).count()


#: Words of 64 bits in the filter of `maybe_in`.
FILTER_WORDS = 1 << 17


def maybe_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose `column` may be in `keys`: all that are, and some that are not.

    A filter of 8 million bits whatever the number of keys is broadcast, so that rows that cannot
    matter are dropped before a join moves them. With very many keys it lets more rows pass; the
    join that follows decides.
    """
    some = _placed(df, column).join(F.broadcast(_bits(keys, key)), "_word")
    return some.where("shiftrightunsigned(_mask, _at) & 1 = 1").drop("_word", "_at", "_mask", "_h")


#: Columns that `rows_without` makes on the way; its rows may have none of these names.
OWN_COLUMNS = {"_h", "_word", "_at", "_mask", "_maybe", "_name"}


def rows_without(df: DataFrame, gone: DataFrame, names: list[str]) -> DataFrame:
    """Rows of `df` whose values of `names` (none null) `gone` does not have.

    Only rows that the filter of `maybe_in` takes for `gone` are moved for the join; all others stay
    where they are read. `df` is read twice.
    """
    name = F.concat_ws(" ", *names)
    marked = _placed(df.withColumn("_name", name), "_name").join(F.broadcast(_bits(gone.select(name.alias("_name")), "_name")), "_word", "left")
    marked = marked.withColumn("_maybe", F.expr("coalesce(shiftrightunsigned(_mask, _at) & 1 = 1, false)"))
    asked = marked.where("_maybe").join(gone.select(*names), names, "left_anti")
    return marked.where("NOT _maybe").select(*df.columns).unionByName(asked.select(*df.columns))


def _placed(of: DataFrame, name: str) -> DataFrame:
    word, bit = f"shiftrightunsigned(_h, 6) & {FILTER_WORDS - 1}", "CAST(_h & 63 AS INT)"
    return of.withColumn("_h", F.xxhash64(F.col(name).cast("string"))).withColumns({"_word": F.expr(word), "_at": F.expr(bit)})


def _bits(keys: DataFrame, key: str) -> DataFrame:
    bits = _placed(keys.select(F.col(key).alias("_key")), "_key")
    return bits.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))
