"""Surrogate keys that stay: a registry of natural keys and the numbers they were given.

Known natural keys keep their number in every refresh; new ones go on from the largest, in their
own order, so numbers are dense over all refreshes. A refresh numbers and writes its new keys only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.keys import key_by_range
from stratalake.sources.filesystem import child_names, exists
from stratalake.sources.staging import Staging


class KeyRegistry:
    """`folder` holds one Parquet folder per refresh, with the keys that it added."""

    def __init__(self, spark: SparkSession, folder: str, keys: T.StructType, number: str):
        self.spark, self.folder, self.number = spark, folder.rstrip("/"), number
        self.keys = keys.names
        self.schema = T.StructType([*keys.fields, T.StructField(number, T.LongType())])

    def refreshes(self) -> list[str]:
        """Committed refreshes, oldest first."""
        names = child_names(self.spark, self.folder)
        return [n for n in names if exists(self.spark, f"{self.folder}/{n}/_SUCCESS")]

    def entries(self) -> DataFrame:
        """Every natural key known so far with its number."""
        folders = [f"{self.folder}/{n}" for n in self.refreshes()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def add(self, df: DataFrame, refresh: str, staging: Staging) -> int:
        """Number the natural keys of `df` that are new; returns how many there were.

        A refresh repeated under its name replaces what an unfinished one left; one that was
        committed is refused, as its keys may be in use.
        """
        if refresh in self.refreshes():
            raise ValueError(f"refresh {refresh!r} is in the registry already")
        known = self.entries()
        named = known.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        # Rows of one key are combined before they are shuffled, so a hot key is a row per task.
        found = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema[: len(self.keys)]]).distinct()
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        new = staging.table(found.join(named, same, "left_anti"))
        last = known.agg(F.coalesce(F.max(self.number), F.lit(0)).cast("bigint")).first()[0]
        numbered = key_by_range(new, self.keys, "_number", staging)
        rows = numbered.select(*self.keys, (F.col("_number") + last).cast("bigint").alias(self.number))
        rows.write.mode("overwrite").parquet(f"{self.folder}/{refresh}")
        return new.count()

    def numbered(self, df: DataFrame) -> DataFrame:
        """`df` with the number of each row's natural key, NULL for keys that were never added."""
        side = self.entries().withColumnsRenamed({k: f"_{k}" for k in self.keys})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        return df.join(side, same, "left").select(*df.columns, self.number)
