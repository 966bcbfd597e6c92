"""Reading the raw files.

A source is `<dir>/<name>.<format>`, either one file or a folder of part files. Values that the
cleaners parse tolerantly are read as text, so that a bad value reaches the cleaner instead of
failing the scan. No reader infers types: that would be another pass over the data.

Every source read carries three columns that stand for the order of its rows (`ROW_ORDER`),
which deduplication needs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from .paths import exists

log = logging.getLogger(__name__)

#: A JSON file that is a bare scalar or an empty object is no longer than this.
BARE_BYTES = 256

ROW_ORDER = ["_src_file", "_src_block", "_src_row"]

# Texts that mean "missing" in a delimited file.
CSV_MISSING = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


@dataclass(frozen=True)
class SourceSpec:
    """Name, columns and time column of a raw source; `renames` maps raw to logical names.

    `change_column` says when a row was last changed. A time that cannot be read fails the job where
    `strict_time` is set and is null elsewhere, as in cleaning.
    """

    name: str
    columns: tuple[str, ...]
    time_column: str | None
    renames: dict[str, str] = field(default_factory=dict)
    required: bool = True
    change_column: str | None = None
    strict_time: bool = False

    @property
    def raw_schema(self) -> StructType:
        """Raw columns as text, but properties as they come: object, text or something else."""
        raw = {logical: name for name, logical in self.renames.items()}
        return StructType(
            [
                StructField(raw.get(c, c), VariantType() if c == "properties" else StringType())
                for c in self.columns
            ]
        )


SOURCES = {
    spec.name: spec
    for spec in (
        SourceSpec(
            "accounts",
            ("account_id", "company_name", "industry", "company_size", "country",
             "signup_date", "status"),
            "signup_date",
            required=False,
        ),
        SourceSpec(
            "user_profiles",
            ("user_id", "account_id", "email", "created_at", "signup_source", "country",
             "role", "company_size", "industry"),
            None,
        ),
        SourceSpec(
            "subscriptions",
            ("subscription_id", "user_id", "plan_name", "status", "start_date", "end_date",
             "monthly_revenue", "created_at", "updated_at"),
            "created_at",
            change_column="updated_at",
        ),
        SourceSpec(
            "transactions",
            ("transaction_id", "user_id", "subscription_id", "amount", "currency",
             "transaction_type", "status", "transaction_date", "payment_method"),
            "transaction_date",
        ),
        SourceSpec(
            "user_events",
            ("event_id", "user_id", "event_type", "event_ts", "properties", "session_id"),
            "event_ts",
            {"timestamp": "event_ts"},
            strict_time=True,
        ),
    )
}


def _read_json(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """A file holding a list of objects, or one object. Malformed text fails the job.

    Such a file is parsed by one task, so large JSON sources should come as a folder of files. A file
    that holds an empty object, null or another scalar has no rows.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader
    bare = _bare_json(spark, path)
    if not bare:
        return reader.json(path)
    every = spark.read.format("binaryFile").load(path).select("path").where(~F.col("path").isin(bare))
    if every.isEmpty():
        fields = list(schema.fields) if schema is not None else []
        empty = spark.createDataFrame([], StructType(fields))
        order = "struct<file_path: string, file_block_start: bigint, row_index: bigint>"
        return empty.withColumn("_metadata", F.lit(None).cast(order))
    names = [r.path for r in every.toLocalIterator()]
    df = reader.json(names)
    return df.select("*", "_metadata")


def _bare_json(spark: SparkSession, path: str) -> list[str]:
    """Files without an object in them. Only files of a few bytes are opened for this."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") <= BARE_BYTES)
    text = F.trim(F.regexp_replace(F.col("content").cast("string"), r"\s", ""))
    bare = (text == "{}") | text.rlike(r'^(null|true|false|-?[0-9.eE+-]+|"[^"]*")$')
    return [r.path for r in files.where(bare).select("path").collect()]


def _read_csv(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """Columns by header name, all as text.

    A quoted field may hold line breaks, so a file is read by one task: large sources should come as
    a folder of files, with one header for all. A row with other than the header's number of fields
    fails the job.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    df = reader.option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    return df.select(
        *[F.when(~F.col(f"`{c}`").isin(*CSV_MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns],
        "_metadata",
    )


def _read_parquet(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    return spark.read.parquet(path)


# Order of preference where several formats are present: columnar first.
FORMATS: dict[str, Callable[[SparkSession, str, StructType | None], DataFrame]] = {
    "parquet": _read_parquet,
    "json": _read_json,
    "csv": _read_csv,
}


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def _file_below(path: str) -> Column:
    """The file of a row without what all files of `path` begin with: it travels with every row."""
    name = path.rstrip("/").rsplit("/", 1)[-1] + "/"
    file = F.col("_metadata.file_path")
    at = F.instr(file, name)  # the first place, hence the same one in all files of the folder
    return F.when(at > 0, file.substr(at + F.lit(len(name)), F.length(file))).otherwise(file)


def _with_row_order(df: DataFrame, suffix: str, path: str) -> DataFrame:
    inner = F.col("_metadata.row_index") if suffix == "parquet" else F.monotonically_increasing_id()
    kept = [F.col(f"`{c}`") for c in df.columns if c != "_metadata"]
    return df.select(
        *kept,
        _file_below(path).alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
        inner.alias("_src_row"),
    )


def read_file(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    since: datetime | None = None,
    time_column: str | Sequence[str] | None = None,
    row_order: bool = False,
    strict_time: bool = True,
) -> DataFrame:
    """Any supported file or folder as a DataFrame; a missing path gives an empty one.

    With `since`, only rows whose `time_column` is strictly later, where that column exists. Of
    several columns the first that is not null counts. Text that is no time fails the job, or
    without `strict_time` counts as null.
    """
    suffix = _suffix(path)
    if not exists(spark, path):
        log.warning("File not found: %s", path)
        fields = list(schema.fields) if schema is not None else []
        if row_order:
            fields += [StructField(c, StringType()) for c in ROW_ORDER]
        return spark.createDataFrame([], StructType(fields))
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported file format: .{suffix}")
    df = FORMATS[suffix](spark, path, schema)
    if since is not None and time_column is not None:
        df = _later_than(df, time_column, since, strict_time)
    if row_order:
        return _with_row_order(df, suffix, path)
    return df.drop("_metadata")


def _later_than(df: DataFrame, columns: str | Sequence[str], since: datetime, strict: bool) -> DataFrame:
    present = [c for c in ([columns] if isinstance(columns, str) else columns) if c in df.columns]
    if not present:
        return df

    def moment(column: str) -> Column:
        value = F.col(f"`{column}`")
        if not isinstance(df.schema[column].dataType, StringType):
            return value
        return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")

    return df.where(F.coalesce(*map(moment, present)) > F.lit(since).cast("timestamp_ntz"))


def read_since(
    df: DataFrame, column: str | Sequence[str], since: datetime | None, strict_time: bool = True
) -> DataFrame:
    """Rows of `df` strictly later than `since`; all of them where there is none."""
    return df if since is None else _later_than(df, column, since, strict_time)


def resolve_source(spark: SparkSession, directory: str, name: str) -> str:
    """The file of a source in a folder, Parquet before JSON before CSV; JSON if none exists."""
    base = directory.rstrip("/")
    for suffix in FORMATS:
        path = f"{base}/{name}.{suffix}"
        if exists(spark, path):
            return path
    return f"{base}/{name}.json"


def read_source(
    spark: SparkSession,
    directory: str,
    name: str,
    since: datetime | None = None,
    changed: bool = False,
) -> DataFrame:
    """One raw source under its logical column names, with its row order.

    With `changed`, "since" also lets through rows that were created before but changed after.
    """
    spec = SOURCES[name]
    raw_names = {logical: raw for raw, logical in spec.renames.items()}
    times = [spec.change_column if changed else None, spec.time_column]
    raw_time = [raw_names.get(c, c) for c in times if c is not None]
    df = read_file(
        spark,
        resolve_source(spark, directory, name),
        spec.raw_schema,
        since,
        raw_time or None,
        row_order=True,
        strict_time=spec.strict_time,
    )
    return df.withColumnsRenamed(spec.renames)


def check_sources(spark: SparkSession, directory: str) -> dict[str, str]:
    """Path per required source; raises if one is missing."""
    paths = {s.name: resolve_source(spark, directory, s.name) for s in SOURCES.values() if s.required}
    missing = [path for path in paths.values() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"Missing source files: {missing}")
    return paths
