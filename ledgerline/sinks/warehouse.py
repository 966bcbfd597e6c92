"""Warehouse tables as Parquet folders, and the ways to load them.

A batch is written once to a staging folder below the warehouse root before it is compared with
the table it goes to. That cuts its lineage: a lost executor costs a re-read of the staged
files, not a re-run of cleaning. Re-running a load that failed half way gives the same table as
a run that did not fail.

A table is a folder of versions. Replacing it writes the next version beside the current one and
then marks it complete; readers take the highest complete version. A replace that fails leaves the
table as it was. The version before the current one stays for readers that began with it, older
ones are removed by the next replace.

Tables that grow with time are partitioned by day or month. Writes to them are rebalanced by
the partition column, which lets Spark join small pieces and split a day that is much larger
than others. An upsert rewrites only the partitions the batch touches; Spark swaps them in when
the whole job has succeeded. Days that an upsert empties are noted before that swap. Once it is done
readers pass over the noted days until the upsert, or the next writer if it could not, has removed
them. Reading never writes. A table has one writer at a time.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import conform, rows_in, rows_not_in, upserted
from ..schemas import PARTITION_COLUMN, PARTITION_RULE, TABLES
from ..sources.paths import children, exists, read_text, remove, total_bytes, write_text
from .key_index import KeyIndex

log = logging.getLogger(__name__)

_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
_COMPLETE, _VACATED = "_complete", "_vacated.json"
#: Bytes of a table from which on an index tells where its keys are.
INDEX_ABOVE = 1 << 30


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, index_above: int = INDEX_ABOVE) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.index_above = index_above

    # Reading

    def path(self, table: str) -> str:
        """The folder of the table's current version."""
        return f"{self.root}/{table}/v{self._version(table)}"

    def _version(self, table: str) -> int:
        """The highest complete version. The first one needs no mark: it is appended to, not swapped."""
        names = children(self.spark, f"{self.root}/{table}")
        numbers = sorted((int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit()), reverse=True)
        for n in numbers:
            if n and exists(self.spark, f"{self.root}/{table}/v{n}/{_COMPLETE}"):
                return n
        return 0

    def schema(self, table: str) -> StructType:
        return TABLES[table]

    def read(self, table: str) -> DataFrame:
        """The table under its declared schema. Columns that older files lack are null, and a
        table never written is empty."""
        while True:
            path, emptied = self.path(table), self._emptied(table)
            if not exists(self.spark, path):
                return self.spark.createDataFrame([], self.schema(table))
            df = self.spark.read.schema(self.schema(table)).parquet(path)
            if (path, emptied) == (self.path(table), self._emptied(table)):
                break  # else an upsert went on while the files were listed
        if not emptied:
            return df
        gone = F.col(PARTITION_COLUMN[table]).cast("string").isin(*emptied)
        return df.where(~F.coalesce(gone, F.lit(False)))

    def sql(self, query: str) -> DataFrame:
        """A query over all tables under their own names."""
        self.register()
        return self.spark.sql(query)

    def register(self) -> None:
        """Makes the tables known to the session's catalog under their own names."""
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table)

    def list_tables(self) -> dict[str, int]:
        """Column count per table, as the session's catalog has them."""
        self.register()
        catalog = self.spark.catalog
        names = sorted(t.name for t in catalog.listTables() if t.name in TABLES)
        return {name: len(catalog.listColumns(name)) for name in names}

    # Creating and emptying

    def create_tables(self) -> None:
        """Creates the tables that do not exist yet, empty."""
        for table in TABLES:
            if not exists(self.spark, self.path(table)):
                self._write_empty(table)

    def truncate(self, tables: Sequence[str] = tuple(TABLES)) -> None:
        for table in tables:
            self._write_empty(table)

    def _write_empty(self, table: str) -> None:
        empty = self.spark.createDataFrame([], self.schema(table))
        self._write_version(table, empty)

    # Writing

    def _write_version(self, table: str, df: DataFrame) -> None:
        """The table's next version. What fails here leaves the current one in place."""
        folder, current = f"{self.root}/{table}", self._version(table)
        held = [int(n[1:]) for n in children(self.spark, folder) if n[0] == "v" and n[1:].isdigit()]
        path = f"{folder}/v{current + 1}"
        for n in held:  # left by a run that failed, or replaced twice
            if n > current or n < current:
                remove(self.spark, f"{folder}/v{n}")
        self._writer(table, df, "errorifexists").parquet(path)
        write_text(self.spark, f"{path}/{_COMPLETE}", "")

    def _writer(self, table: str, df: DataFrame, mode: str, only_touched: bool = False):
        writer = df.write.mode(mode).option(
            "partitionOverwriteMode", "dynamic" if only_touched else "static"
        )
        column = PARTITION_COLUMN.get(table)
        return writer.partitionBy(column) if column else writer

    def write(
        self,
        table: str,
        df: DataFrame,
        if_exists: str = "append",
        sequence: str | None = None,
        only_touched: bool = False,
        listed: bool = False,
    ) -> int:
        """Writes rows that already have the table's columns; returns how many.

        `sequence` names a key column to number consecutively upwards from the highest value in
        use, with gaps. Numbers are given in the writing stage itself, by task, so no order has
        to be established over all rows. Unless the rows are `listed` in the index of the table's
        keys, that is dropped; the next load that needs it builds it again.
        """
        if not listed and exists(self.spark, self._index_folder(table)):
            remove(self.spark, self._index_folder(table))
        out = df
        column = PARTITION_COLUMN.get(table)
        if column:
            out = out.hint("rebalance", column)
        if sequence:
            highest = self.read(table).agg(F.max(sequence)).first()[0]
            start = 0 if highest is None else highest + 1
            out = out.withColumn(sequence, F.monotonically_increasing_id() + start)
        rows = Observation()
        out = out.observe(rows, F.count(F.lit(1)).alias("n"))
        if _MODES[if_exists] == "overwrite" and not only_touched:
            self._write_version(table, out)
        else:
            self._writer(table, out, _MODES[if_exists], only_touched).parquet(self.path(table))
        return rows.get["n"]

    def _prepared(self, table: str, batch: DataFrame, run_ts: datetime) -> DataFrame:
        """The batch in the table's columns, stamped and with its partition value."""
        stamp = F.lit(run_ts).cast("timestamp_ntz")
        stamps = [c for c in ("ingested_at", "loaded_at") if c in self.schema(table).names]
        stamped = batch.withColumns({c: stamp for c in stamps})
        if table in PARTITION_RULE:
            stamped = conform(stamped, self.schema(table)).withColumn(
                PARTITION_COLUMN[table], F.expr(PARTITION_RULE[table])
            )
        return conform(stamped, self.schema(table))

    @contextmanager
    def _staged(self, table: str, df: DataFrame) -> Iterator[DataFrame]:
        path = f"{self.root}/_staging/{table}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(self.schema(table)).parquet(path)
        finally:
            remove(self.spark, path)

    def _index_folder(self, table: str) -> str:
        return f"{self.root}/_keys/{table}"

    def _index(self, table: str, keys: Sequence[str]) -> KeyIndex | None:
        """The index of the table's keys. It is built if it is missing and the table is large enough."""
        column = PARTITION_COLUMN.get(table)
        if column is None or column in keys:
            return None
        path = self.path(table)
        index = KeyIndex(self.spark, self._index_folder(table), path.rsplit("/", 1)[1], keys, column)
        if not index.exists():
            if total_bytes(self.spark, path) < self.index_above:
                return None
            index.build(self.read(table))
        return index

    def _is_empty(self, table: str) -> bool:
        return not exists(self.spark, self.path(table)) or self.read(table).isEmpty()

    def insert_new(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        run_ts: datetime,
        sequence: str | None = None,
    ) -> int:
        """Appends the rows whose key the table does not hold yet; returns how many.

        Rows already held are never changed, so a later version of a row has no effect. The batch
        holds each key once; the cleaners see to that.
        """
        prepared = self._prepared(table, batch, run_ts)
        self._finish_removal(table)
        if self._is_empty(table):
            return self.write(table, prepared, sequence=sequence)
        with self._staged(table, prepared) as staged:
            size = staged.count()
            if size == 0:
                log.warning("No data to load to %s", table)
                return 0
            held, index = self.read(table), self._index(table, keys)
            if index is None:
                return self.write(table, rows_not_in(held, staged, keys, size), sequence=sequence)
            with index.find(staged, size) as found:
                held = self._in_partitions(table, held, index.partitions(found))
                index.add(found)
            return self.write(table, rows_not_in(held, staged, keys, size), sequence=sequence, listed=True)

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        update_columns: Sequence[str],
        run_ts: datetime,
    ) -> int:
        """Inserts new rows and updates `update_columns` of rows held; returns the batch size.

        The batch holds each key once. Columns not updated keep their value, so `ingested_at`
        stays the time a row first arrived.
        """
        prepared = self._prepared(table, batch, run_ts)
        self._finish_removal(table)
        if self._is_empty(table):
            return self.write(table, prepared)
        with self._staged(table, prepared) as staged:
            size = staged.count()
            if size == 0:
                log.warning("No data to load to %s", table)
            elif table in PARTITION_COLUMN:
                self._upsert_partitions(table, staged, keys, update_columns, size)
            else:
                merged = upserted(self.read(table), staged, keys, update_columns, size)
                self.write(table, merged, "replace")
            return size

    def _upsert_partitions(
        self, table: str, batch: DataFrame, keys: Sequence[str], update_columns: Sequence[str], size: int
    ) -> None:
        column = PARTITION_COLUMN[table]
        target = self.read(table)
        # Values of the partition column are days or months: few, and one row each here.
        coming = self._partitions(batch, column)
        leaving: set = set()
        index = self._index(table, keys)
        if column not in keys:
            held = target
            if index is not None:
                with index.find(batch, size) as found:
                    held = self._in_partitions(table, target, index.partitions(found) - coming)
                    index.add(found)
            moved_from = rows_in(held.select(*keys, column), batch, keys, size)
            leaving = self._partitions(moved_from, column) - coming
        touched = target.where(F.col(column).isin(*coming, *leaving))
        updates = [*update_columns, *([] if column in keys else [column])]
        merged = upserted(touched, batch, keys, updates, size)
        # A partition all of whose rows moved elsewhere gets no new files, hence no overwrite.
        # Files that stand now in the days that change tell later whether the swap took place.
        before = {str(v): self._files(table, v) for v in (coming | leaving)}
        if leaving:
            note = {"changing": {str(v): before[str(v)] for v in coming}, "leaving": {str(v): before[str(v)] for v in leaving}}
            write_text(self.spark, f"{self.path(table)}/{_VACATED}", json.dumps(note))
        self.write(table, merged, "replace", only_touched=True, listed=index is not None)
        self._finish_removal(table)

    def _files(self, table: str, value: object) -> list[str]:
        folder = f"{self.path(table)}/{PARTITION_COLUMN[table]}={value}"
        return [n for n in children(self.spark, folder) if n[0] not in "._"]

    def _emptied(self, table: str) -> list[str]:
        """Days that an upsert has emptied but not removed yet. Readers pass over them, and write nothing.

        A day that the upsert left with rows has new files by then, and keeps them: only a day that
        still has exactly its files from before counts, and only once all other days are swapped in.
        """
        note = f"{self.path(table)}/{_VACATED}"
        if table not in PARTITION_COLUMN or not exists(self.spark, note):
            return []
        try:
            told = json.loads(read_text(self.spark, note))
        except Exception:
            if exists(self.spark, note):
                raise
            return []  # removed by its upsert in the meantime
        if not all(self._files(table, v) not in (old, []) for v, old in told["changing"].items()):
            return []
        return sorted(v for v, old in told["leaving"].items() if old and self._files(table, v) == old)

    def _finish_removal(self, table: str) -> None:
        """Removes emptied days and the note of them; for the one writer of a table only."""
        for value in self._emptied(table):
            remove(self.spark, f"{self.path(table)}/{PARTITION_COLUMN[table]}={value}")
        note = f"{self.path(table)}/{_VACATED}"
        if table in PARTITION_COLUMN and exists(self.spark, note):
            remove(self.spark, note)

    @staticmethod
    def _in_partitions(table: str, df: DataFrame, values: set) -> DataFrame:
        column = F.col(PARTITION_COLUMN[table])
        named = column.isin(*[v for v in values if v is not None])
        return df.where(named | column.isNull() if None in values else named)

    @staticmethod
    def _partitions(df: DataFrame, column: str) -> set:
        return {row[0] for row in df.select(column).distinct().collect()}

    def replace(self, table: str, batch: DataFrame, run_ts: datetime) -> int:
        """Replaces the whole table, keeping its declared columns; an empty batch does not."""
        with self._staged(table, self._prepared(table, batch, run_ts)) as staged:
            if staged.isEmpty():
                log.warning("No data to load to %s", table)
                return 0
            return self.write(table, staged, "replace")
