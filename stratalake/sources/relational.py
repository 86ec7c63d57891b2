"""Layer tables in a relational database, behind the calls that plans make on a LayerStore.

A database table has one state, which every reader sees at once. A gold refresh therefore empties
the fact table, replaces the dimensions and fills the fact table last, with rows that were checked
in the shared folder before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.schemas import GOLD_TABLES, TABLES
from stratalake.sources import jdbc
from stratalake.sources.layers import OPEN_LAYERS
from stratalake.sources.staging import Staging


class RelationalStore:
    """`names` maps (layer, table) to the table's name in the database, by default layer.table."""

    def __init__(
        self, spark: SparkSession, connection: Mapping[str, str],
        names: Mapping[tuple[str, str], str] | None = None,
        tables: Mapping[tuple[str, str], T.StructType] = TABLES,
        splits: Mapping[tuple[str, str], jdbc.KeySplit] | None = None,
    ):
        self.spark, self.connection, self.tables = spark, dict(connection), dict(tables)
        self.names, self.splits = dict(names or {}), dict(splits or {})
        self._held: dict[tuple[str, str], tuple[DataFrame, Staging]] = {}

    def name(self, layer: str, table: str) -> str:
        return self.names.get((layer, table), f"{layer}.{table}")

    def write(
        self, df: DataFrame, layer: str, table: str, version: str,
        partition_by: Sequence[str] = (), metrics: Mapping | None = None, publish: bool = True,
    ) -> dict[str, int]:
        """Replace a table; returns what was counted on the way. Without `publish` the rows wait
        in the shared folder. `version` and `partition_by` mean nothing to a database."""
        schema = self.tables[(layer, table)]
        counted = Observation(f"{layer}.{table}")
        extra = [column.alias(name) for name, column in (metrics or {}).items()]
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *extra)
        rows = observed.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns
        ])
        if publish:
            jdbc.write_table(rows, self.connection, self.name(layer, table))
        else:
            staging = Staging(self.spark)
            self._held[layer, table] = staging.table(rows), staging
        return dict(counted.get)

    def begin(self, layer: str, table: str, version: str) -> None:
        """Empty a table before those that it refers to are replaced."""
        self.reset(layer, table, version)

    def publish(self, layer: str, table: str, version: str) -> None:
        rows, staging = self._held.pop((layer, table))
        jdbc.write_table(rows, self.connection, self.name(layer, table))
        staging.clear()

    def unpublish(self, layer: str, table: str, version: str) -> None:
        self.reset(layer, table, version)

    def withdraw(self, layer: str, table: str, version: str) -> None:
        """Drop rows that wait, or empty a table that was written."""
        held = self._held.pop((layer, table), None)
        if held:
            held[1].clear()
        else:
            self.reset(layer, table, version)

    def reset(self, layer: str, table: str, version: str = "") -> None:
        empty = self.spark.createDataFrame([], self.tables[(layer, table)])
        jdbc.reset_table(empty, self.connection, self.name(layer, table))

    def read(
        self, layer: str, table: str, version: str | None = None, row_id: str | None = None
    ) -> DataFrame:
        """The table, or the rows that wait to become it. `row_id` adds a hash of each row."""
        held = self._held.get((layer, table))
        df = held[0] if held else jdbc.read_table(
            self.spark, self.connection, self.name(layer, table), self.splits.get((layer, table))
        )
        names = df.columns if layer in OPEN_LAYERS else self.tables[(layer, table)].names
        rows = df.select(*names)
        return rows if row_id is None else rows.withColumn(row_id, F.xxhash64(*names))

    def newest_shared(self, layer: str, tables: Sequence[str]) -> str:
        return ""

    def gold(self) -> dict[str, DataFrame]:
        return {t: self.read("gold", t) for t in GOLD_TABLES}
