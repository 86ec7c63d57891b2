"""Exact medians across loads, from histograms that are added instead of recomputed.

Every load leaves the first histogram of its columns, a few million rows at most whatever its size.
The histogram of all loads is their sum. It settles the medians of everyday numbers alone; for the
others it names the bucket that holds the middle, and all loads are read for that bucket only, with
filters that reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.medians import counts_in_bigint, medians_of_histogram, narrow_histogram
from stratalake.sources.filesystem import child_names, exists

_STATE = T.StructType([
    T.StructField("column_id", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("n", T.LongType()),
])


class RankState:
    """`folder` holds one histogram per load; `schema` names the columns, which all loads have."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        unfit = [f.name for f in schema if not counts_in_bigint(f.dataType)]
        if unfit:
            raise ValueError(f"no numbers of up to 18 digits: {unfit}")
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def loads(self) -> list[str]:
        names = child_names(self.spark, self.folder)
        return [n for n in names if exists(self.spark, f"{self.folder}/{n}/_SUCCESS")]

    def _columns(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def add(self, df: DataFrame, load: str) -> None:
        """Count a load. Its rows are read once, here; a load is counted at most once by name."""
        if load in self.loads():
            raise ValueError(f"load {load!r} is counted already")
        histogram = narrow_histogram(self._columns(df), self.schema.names)
        histogram.select(*[F.col(f.name).cast(f.dataType) for f in _STATE]).write.mode("overwrite").parquet(
            f"{self.folder}/{load}"
        )

    def histogram(self) -> DataFrame:
        """The sum over all loads."""
        folders = [f"{self.folder}/{n}" for n in self.loads()]
        if not folders:
            return self.spark.createDataFrame([], _STATE)
        counted = self.spark.read.schema(_STATE).parquet(*folders)
        return counted.groupBy("column_id", "start").agg(F.sum("n").alias("n"))

    def medians(self, loads: Sequence[DataFrame]) -> DataFrame:
        """(column_name, median double) over all counted loads, whose rows `loads` are."""
        whole = None
        for df in loads:
            own = self._columns(df)
            whole = own if whole is None else whole.unionByName(own)
        if whole is None:
            whole = self.spark.createDataFrame([], self.schema)
        return medians_of_histogram(whole, self.schema.names, self.histogram())
