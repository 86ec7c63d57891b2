"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage: what was written is what every later job reads, also after an
executor is lost, which partition-dependent numbering needs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.filesystem import remove_tree


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stratalake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Folders of this process that were not cleared yet.
_LEFT: dict[str, SparkSession] = {}


class Staging:
    """Staged tables of one unit of work, removed together when it is left.

    Where a result is returned that still reads them, whoever consumes it calls clear_staged().
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
        _LEFT[self.path] = spark

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self) -> str:
        """A fresh path for files written in another format."""
        return f"{self.path}/{uuid.uuid4().hex}"

    def clear(self) -> None:
        remove_tree(self.spark, self.path)
        _LEFT.pop(self.path, None)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *exc_info) -> None:
        self.clear()


def clear_staged() -> None:
    """Remove everything this process has staged; call it once results have been consumed."""
    for path, spark in list(_LEFT.items()):
        remove_tree(spark, path)
        del _LEFT[path]


@contextmanager
def staged_results() -> Iterator[None]:
    """Clear on leaving what is staged inside: consume results before the end of the block."""
    before = set(_LEFT)
    try:
        yield
    finally:
        for path in [p for p in _LEFT if p not in before]:
            remove_tree(_LEFT[path], path)
            del _LEFT[path]
