"""The files of a folder whose schema was checked, so that each is opened once.

A manifest is a small Parquet table kept with a stream's checkpoint: path, size, time of change,
fingerprint and columns of every file that passed. A refresh lists the folder, leaves out what the
manifest has, and reads the footers of the rest; a file that was replaced counts as new. Listing
opens nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.filesystem import child_names, remove_tree

MANIFEST = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("changed", T.TimestampType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("columns", T.StringType()),
])
# Footers read at once, each by a task of its own.
_AT_ONCE = 16
# New files whose rows are added to the manifest together.
_BATCH = 1000
# Parts of a manifest above which it is written anew as one.
_MOST_PARTS = 50


class SchemaDrift(ValueError):
    """A file has other columns than the folder's first file."""


def columns_of(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def fingerprint(schema: T.StructType) -> str:
    """Equal for files with the same columns and types, in any order."""
    return hashlib.sha256(json.dumps(sorted(columns_of(schema).items())).encode()).hexdigest()


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, size and time of change of the Parquet files below a folder, contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def read_footer(spark: SparkSession, path: str) -> T.StructType:
    """A file's schema, from its footer, which a task reads."""
    return spark.read.parquet(path).schema


class FileManifest:
    """`folder`: a place of its own, below the checkpoint for instance."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _parts(self) -> list[str]:
        return [f"{self.folder}/{n}" for n in child_names(self.spark, self.folder) if n.startswith("part-")]

    def files(self) -> DataFrame:
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(*parts)

    def schema(self) -> T.StructType | None:
        """The columns that all files of the manifest share."""
        first = self.files().select("columns").head()
        return T.StructType.fromJson(json.loads(first["columns"])) if first else None

    def unseen(self, folder: str) -> DataFrame:
        """Files of `folder` that are not in the manifest as they are now."""
        return listed(self.spark, folder).join(self.files(), ["path", "size", "changed"], "left_anti")

    def _add(self, rows: Iterable[tuple]) -> None:
        added = self.spark.createDataFrame(list(rows), MANIFEST).coalesce(1)
        added.write.mode("append").parquet(self.folder)

    def compact(self) -> None:
        """One part for all; the old ones go once it is there."""
        parts = self._parts()
        if len(parts) > 1:
            self.files().dropDuplicates(["path", "size", "changed"]).coalesce(1).write.mode("append").parquet(self.folder)
            for part in parts:
                remove_tree(self.spark, part)

    def check(self, folder: str) -> T.StructType | None:
        """Open the unseen files of `folder`, refuse one that differs, remember the others.

        Returns the schema of all files, None if there was never one. Files before one that is
        refused stay remembered; that one does not.
        """
        expected = self.schema()
        unseen = self.unseen(folder).orderBy("path").toLocalIterator()

        def with_schema(row) -> tuple:
            return row, read_footer(self.spark, row["path"])

        with ThreadPoolExecutor(_AT_ONCE) as pool:
            while batch := list(islice(unseen, _BATCH)):
                passed, refused = [], None
                for row, schema in pool.map(with_schema, batch):
                    expected = expected or schema
                    if columns_of(schema) != columns_of(expected):
                        differing = set(columns_of(schema).items()) ^ set(columns_of(expected).items())
                        refused = SchemaDrift(f"{row['path']}: differs in {sorted(differing)}")
                        break
                    passed.append((row["path"], row["size"], row["changed"], fingerprint(schema), expected.json()))
                if passed:
                    self._add(passed)
                if refused:
                    raise refused
        if len(self._parts()) > _MOST_PARTS:
            self.compact()
        return expected

