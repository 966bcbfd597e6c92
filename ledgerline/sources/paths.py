"""Existence and removal of paths on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    system, target = _hadoop(spark, path)
    system.delete(target, True)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 for a missing one."""
    system, target = _hadoop(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def total_files(spark: SparkSession, path: str) -> int:
    """Number of all files below a path; 0 for a missing one."""
    system, target = _hadoop(spark, path)
    return system.getContentSummary(target).getFileCount() if system.exists(target) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; nothing for a missing folder."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Creates a small file. It appears under its name only once it is complete."""
    system, target = _hadoop(spark, path)
    _, draft = _hadoop(spark, f"{path}.draft")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(target, False)
    system.rename(draft, target)


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _hadoop(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
