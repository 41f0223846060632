"""Folders of tables, by the file system that Spark itself uses for a path.

PySpark has no public call that lists, removes or renames files, so this is the one place that asks Spark's JVM for its file system.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    system, at = _at(spark, path)
    system.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, at = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    if not system.rename(at, target):
        raise OSError(f"{path} cannot be renamed to {to}")
