"""Which partitions of a table hold a key, kept beside the table as a table of its own.

A load has to know where the keys of its batch are stored. Without an index that is a scan of the
key column of all days. The index holds (key columns, partition value) in folders by a hash of the
key. A load reads the folders its keys fall into, keeps the entries of its own keys, and then reads
only the partitions these name. Each load adds the entries of its rows.

Entries are hints. They are written before the rows they speak of, so a key that is stored is always
listed, while an entry may outlive its row after a move or a load that died. Callers therefore look
for the keys themselves in the partitions named, which makes an entry too many cost time only.

The number of folders follows from the number of entries. Once loads have left `MERGE_AT` files a
folder, the entries are written anew as the next generation, in as many folders as they need by then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..operators.merge import BROADCAST_ROWS, rows_in
from ..sources.paths import children, exists, read_text, remove, total_files, write_text

#: Entries that a folder is made for, and files a folder from which on all are written anew.
ENTRIES, MERGE_AT = 4_000_000, 32
_BUCKET, _MARK = "key_bucket", "_index.json"


class KeyIndex:
    def __init__(self, spark: SparkSession, folder: str, of: str, keys: Sequence[str], column: str) -> None:
        """The index in `folder` of the table version `of`, by `keys`, with values of `column`."""
        self.spark, self.folder, self.of = spark, folder, of
        self.keys, self.column = list(keys), column

    def _generations(self) -> list[int]:
        return sorted(int(n[1:]) for n in children(self.spark, self.folder) if n[0] == "g" and n[1:].isdigit())

    def _current(self) -> tuple[str, int] | None:
        """Path and number of folders of the latest complete generation, if it is of this version."""
        for n in reversed(self._generations()):
            path = f"{self.folder}/g{n}"
            if exists(self.spark, f"{path}/{_MARK}"):
                told = json.loads(read_text(self.spark, f"{path}/{_MARK}"))
                fits = (told["of"], told["keys"], told["column"]) == (self.of, self.keys, self.column)
                return (path, told["buckets"]) if fits else None
        return None

    def exists(self) -> bool:
        return self._current() is not None

    def drop(self) -> None:
        remove(self.spark, self.folder)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(buckets)).cast("int")

    def _write(self, entries: DataFrame, path: str, buckets: int) -> None:
        out = entries.select(*self.keys, self.column).withColumn(_BUCKET, self._bucket(buckets))
        out.hint("rebalance", _BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(path)

    def _read(self, path: str, like: DataFrame) -> DataFrame:
        schema = like.select(*self.keys, self.column).schema.add(_BUCKET, IntegerType())
        return self.spark.read.schema(schema).parquet(path)

    def build(self, rows: DataFrame) -> None:
        """A new generation of the keys and partition values of `rows`."""
        entries = rows.select(*self.keys, self.column).distinct()
        n = (self._generations() or [-1])[-1]
        path, buckets = f"{self.folder}/g{n + 1}", max(1, -(-rows.count() // ENTRIES))
        self._write(entries, path, buckets)
        told = {"of": self.of, "keys": self.keys, "column": self.column, "buckets": buckets}
        write_text(self.spark, f"{path}/{_MARK}", json.dumps(told))
        for old in range(n + 1):
            remove(self.spark, f"{self.folder}/g{old}")

    @contextmanager
    def find(self, batch: DataFrame, rows: int | None = None) -> Iterator[DataFrame]:
        """For each key of `batch` its partition values there and those listed, written once.

        Read are the folders these keys fall into. Keys of a large batch meet the entries in one shuffle;
        a small one is held against the entries where they are read. `rows` is the size of the batch.
        """
        path, buckets = self._current()
        entries = self._read(path, batch)
        if buckets > 1:
            asked = batch.select(self._bucket(buckets).alias("b")).distinct().collect()
            entries = entries.where(F.col(_BUCKET).isin(*[row["b"] for row in asked]))
        if rows is None or rows <= BROADCAST_ROWS:
            entries = rows_in(entries, batch, self.keys, rows)
        keys, value = [F.col(f"`{k}`") for k in self.keys], F.struct(F.col(f"`{self.column}`").alias("v"))
        both = batch.select(*keys, value.alias("_own")).unionByName(entries.select(*keys, value.alias("_known")), allowMissingColumns=True)
        met = both.groupBy(*keys).agg(F.collect_set("_own").alias("_own"), F.collect_set("_known").alias("_known"))
        for left in children(self.spark, self.folder):  # by a load that died
            if left.startswith("found-"):
                remove(self.spark, f"{self.folder}/{left}")
        at, met = f"{self.folder}/found-{uuid.uuid4().hex}", met.where(F.size("_own") > 0)
        met.write.parquet(at)
        try:
            yield self.spark.read.schema(met.schema).parquet(at)
        finally:
            remove(self.spark, at)

    def partitions(self, found: DataFrame) -> set:
        """Partition values listed for the keys in `found`: few, a row each here."""
        return {row[0] for row in found.select(F.explode("_known").alias("_k")).select("_k.v").distinct().collect()}

    def add(self, found: DataFrame) -> None:
        """Lists the rows of the batch that `found` is of, but for entries that are there."""
        path, buckets = self._current()
        new = F.filter("_own", lambda own: ~F.exists("_known", lambda known: known["v"].eqNullSafe(own["v"])))
        rows = found.select(*[F.col(f"`{k}`") for k in self.keys], F.explode(new).alias("_n"))
        rows = rows.withColumn(self.column, F.col("_n.v")).drop("_n")
        self._write(rows, path, buckets)
        if total_files(self.spark, path) >= MERGE_AT * buckets:
            self.build(self._read(path, rows))
