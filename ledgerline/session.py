"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # JSON objects that repeat a key are valid text and must survive normalisation.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Sessions of a user are merged in each task before they meet.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of rows that go to a Python worker at once. Both the JVM and the worker hold them several times over.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Has Spark send rows to Python workers `BATCH_BYTES` at a time, unless the session sets a bound itself.

    Spark's own bound is 64 MB, which rows of long texts and packed hashes reach.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in `spark.checkpoint.dir`.

    Only where that setting is absent and everything runs in one process (tests) is a local folder
    made; executors on other machines would not see it, so a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all of {master} shares")
        base = tempfile.mkdtemp(prefix="ledgerline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
