"""Incremental event loads by Structured Streaming.

Spark's checkpoint remembers which files were loaded, so no "since" has to be kept by hand. The
load of a micro-batch is an upsert by event id, so a batch repeated after a failure changes
nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import load_user_events
from ..session import configure
from ..sinks.warehouse import Warehouse
from ..sources.files import ROW_ORDER, SOURCES


def load_new_event_files(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    checkpoint: str,
    run_ts: datetime,
    schema: str,
) -> None:
    """Loads the Parquet files that arrived in `folder` since the last call, then returns.

    `schema` is the DDL of the raw events under their raw names.
    """
    configure(spark)
    raw = (
        spark.readStream.schema(schema)
        .parquet(folder)
        .select(
            "*",
            F.col("_metadata.file_path").alias(ROW_ORDER[0]),
            F.col("_metadata.file_block_start").alias(ROW_ORDER[1]),
            F.col("_metadata.row_index").alias(ROW_ORDER[2]),
        )
        .withColumnsRenamed(SOURCES["user_events"].renames)
    )

    def load(batch: DataFrame, _: int) -> None:
        profiles = warehouse.read("user_profiles")
        load_user_events(warehouse, batch, profiles, run_ts)

    query = (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
