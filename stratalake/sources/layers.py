"""Layer tables as versioned Parquet folders: <root>/<layer>/<table>/<version>.

A write goes to a new version folder, which readers ignore until Spark's commit leaves its
_SUCCESS marker; a failed load therefore keeps the last good table. Versions are named after
the run, so all tables of a run share one version and can be read together.

Bronze is open: it keeps columns that its schema does not name, and is read as it was written,
so that silver sees which of its variants an extract had. The other layers are written and read
in exactly their schema. Columns that start with an underscore are never written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.schemas import GOLD_TABLES, TABLES
from stratalake.sources.filesystem import child_names, exists, remove_tree, touch

OPEN_LAYERS = ("bronze",)


class LayerStore:
    def __init__(
        self, spark: SparkSession, root: str,
        tables: Mapping[tuple[str, str], T.StructType] = TABLES,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables)

    def path(self, layer: str, table: str, version: str) -> str:
        return f"{self.root}/{layer}/{table}/{version}"

    def versions(self, layer: str, table: str) -> list[str]:
        """Committed versions, oldest first."""
        names = child_names(self.spark, f"{self.root}/{layer}/{table}")
        return [n for n in names if exists(self.spark, f"{self.path(layer, table, n)}/_SUCCESS")]

    def write(
        self, df: DataFrame, layer: str, table: str, version: str,
        partition_by: Sequence[str] = (), metrics: Mapping | None = None, publish: bool = True,
    ) -> dict[str, int]:
        """Write one version; returns what was counted on the way.

        `rows` is always counted; `metrics` adds aggregates over df. Counting rides on the write,
        so nothing is computed twice. Without `publish` the version stays invisible to readers
        that do not name it, until publish() is called.
        """
        schema = self.tables[(layer, table)]
        counted = Observation(f"{layer}.{table}")
        extra = [column.alias(name) for name, column in (metrics or {}).items()]
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *extra)
        written = [
            F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns
        ]
        if layer in OPEN_LAYERS:
            written += [c for c in df.columns if c not in schema.names and not c.startswith("_")]
        writer = observed.select(*written).write.mode("overwrite").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", str(publish).lower()
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(layer, table, version))
        return dict(counted.get)

    def begin(self, layer: str, table: str, version: str) -> None:
        """Nothing to prepare: a version is invisible until it is published."""

    def publish(self, layer: str, table: str, version: str) -> None:
        """Show a version that was written without."""
        touch(self.spark, f"{self.path(layer, table, version)}/_SUCCESS")

    def unpublish(self, layer: str, table: str, version: str) -> None:
        """Hide a version; its files stay for inspection."""
        remove_tree(self.spark, f"{self.path(layer, table, version)}/_SUCCESS")

    def reset(self, layer: str, table: str, version: str) -> None:
        """Publish an empty table of the declared schema."""
        empty = self.spark.createDataFrame([], self.tables[(layer, table)])
        empty.write.mode("overwrite").parquet(self.path(layer, table, version))

    def define(self, version: str, replace: bool = False) -> list[tuple[str, str]]:
        """Publish an empty version of every table that has none yet, or of all of them.

        Earlier versions stay in place; `replace` only makes the empty ones the newest.
        """
        made = [key for key in self.tables if replace or not self.versions(*key)]
        for layer, table in made:
            self.reset(layer, table, version)
        return made

    def read(
        self, layer: str, table: str, version: str | None = None, row_id: str | None = None
    ) -> DataFrame:
        """A committed version, by default the newest.

        `row_id` adds a 64-bit hash of each row's place in the files: the same on every reading.
        """
        if version is None:
            committed = self.versions(layer, table)
            if not committed:
                raise FileNotFoundError(f"{layer}.{table} has no committed version in {self.root}")
            version = committed[-1]
        reader = self.spark.read
        if layer not in OPEN_LAYERS:
            reader = reader.schema(self.tables[(layer, table)])
        df = reader.parquet(self.path(layer, table, version))
        names = df.columns if layer in OPEN_LAYERS else self.tables[(layer, table)].names
        if row_id is None:
            return df.select(*names)
        place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        return df.select(*names, place.alias(row_id))

    def shared_versions(self, layer: str, tables: Sequence[str]) -> list[str]:
        """Versions that all the tables have, oldest first."""
        return sorted(set.intersection(*[set(self.versions(layer, t)) for t in tables]))

    def newest_shared(self, layer: str, tables: Sequence[str]) -> str:
        shared = self.shared_versions(layer, tables)
        if not shared:
            raise FileNotFoundError(f"{layer} has no version with all of {list(tables)}")
        return shared[-1]

    def snapshot(self, layer: str, tables: Sequence[str]) -> dict[str, DataFrame]:
        """The newest version that all the tables have, so that their keys belong together."""
        version = self.newest_shared(layer, tables)
        return {t: self.read(layer, t, version) for t in tables}

    def gold(self) -> dict[str, DataFrame]:
        return self.snapshot("gold", GOLD_TABLES)

    def withdraw(self, layer: str, table: str, version: str) -> None:
        """Take back one version, for instance one that failed its checks."""
        remove_tree(self.spark, self.path(layer, table, version))

    def expire(self, layer: str, keep: int = 2) -> list[tuple[str, str]]:
        """Delete what is older than a layer's newest `keep` complete versions.

        Only versions that all tables of the layer have count as kept, so unfinished runs never
        push out the last one that readers can use. Returns (table, version) of what was deleted.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        tables = [t for in_layer, t in self.tables if in_layer == layer]
        kept = self.shared_versions(layer, tables)[-keep:]
        if not kept:
            return []
        old = [
            (t, name) for t in tables
            for name in child_names(self.spark, f"{self.root}/{layer}/{t}") if name < kept[0]
        ]
        for table, version in old:
            self.withdraw(layer, table, version)
        return old

    def register(self, layer: str, tables: Sequence[str]) -> None:
        """Make a snapshot queryable in SQL as <layer>.<table>.

        Database and tables live in the session's catalog; the tables are external, so dropping
        or replacing them leaves the files alone.
        """
        version = self.newest_shared(layer, tables)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
            self.spark.catalog.createTable(
                f"{layer}.{table}", path=self.path(layer, table, version), source="parquet",
                schema=self.read(layer, table, version).schema,
            )
