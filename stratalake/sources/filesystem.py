"""Thin calls to the Hadoop file system, so paths work on any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, or empty an existing one."""
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
