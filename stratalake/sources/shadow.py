"""Gold tables in a database, replaced all at once.

A refresh loads the four tables beside the ones that readers use, under names with a suffix, and
checks them there. Only then are names swapped, by one list of statements in one transaction; the
tables replaced stay under a suffix of their own until the next refresh, so that a gold that fails
a later check can be swapped back. Whatever fails before the swap leaves fact and dimensions as
they were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.schemas import GOLD_TABLES
from stratalake.sources import jdbc
from stratalake.sources.relational import RelationalStore

NEXT, PREVIOUS = "__next", "__previous"
# (table, column, referenced table and column of the same name)
REFERENCES = [
    ("fact_customer_churn", "customer_sk", "dim_customer"),
    ("fact_customer_churn", "service_sk", "dim_service"),
    ("fact_customer_churn", "contract_sk", "dim_contract"),
]


@dataclass(frozen=True)
class Dialect:
    """Statement templates; the defaults are PostgreSQL's. `{name}` is a name without schema."""

    create: str = "CREATE TABLE {new} (LIKE {old} INCLUDING ALL)"
    reference: str = "ALTER TABLE {table} ADD FOREIGN KEY ({column}) REFERENCES {target} ({column})"
    rename: str = "ALTER TABLE {table} RENAME TO {name}"
    drop: str = "DROP TABLE IF EXISTS {table}"


class ShadowStore(RelationalStore):
    """A RelationalStore whose gold is replaced in one transaction."""

    def __init__(
        self, spark: SparkSession, connection: Mapping[str, str], dialect: Dialect = Dialect(),
        references: Sequence[tuple[str, str, str]] = tuple(REFERENCES), **settings,
    ):
        super().__init__(spark, connection, **settings)
        self.dialect, self.references = dialect, list(references)
        self._open: str | None = None

    def _beside(self, table: str, suffix: str) -> str:
        return f"{self.name('gold', table)}{suffix}"

    def _plain(self, table: str, suffix: str = "") -> str:
        return f"{self.name('gold', table).rsplit('.', 1)[-1]}{suffix}"

    def _execute(self, statements: Sequence[str]) -> None:
        jdbc.execute(self.spark, self.connection, statements)

    def _dropped(self, suffix: str) -> list[str]:
        """Tables that refer to others go first."""
        return [self.dialect.drop.format(table=self._beside(t, suffix)) for t in reversed(GOLD_TABLES)]

    def begin(self, layer: str, table: str, version: str) -> None:
        """Empty tables beside gold, in place of what an unfinished refresh may have left."""
        if layer != "gold":
            return super().begin(layer, table, version)
        self._execute([*self._dropped(NEXT), *(
            self.dialect.create.format(new=self._beside(t, NEXT), old=self.name("gold", t)) for t in GOLD_TABLES
        )])
        self._open = version

    def write(
        self, df: DataFrame, layer: str, table: str, version: str,
        partition_by: Sequence[str] = (), metrics: Mapping | None = None, publish: bool = True,
    ) -> dict[str, int]:
        if layer != "gold" or version != self._open:
            return super().write(df, layer, table, version, partition_by, metrics, publish)
        counted = Observation(f"{layer}.{table}")
        extra = [column.alias(name) for name, column in (metrics or {}).items()]
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *extra)
        rows = observed.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in self.tables[(layer, table)] if f.name in df.columns
        ])
        jdbc.write_table(rows, self.connection, self._beside(table, NEXT))
        return dict(counted.get)

    def read(
        self, layer: str, table: str, version: str | None = None, row_id: str | None = None
    ) -> DataFrame:
        """The table, or with the version of an open refresh the one beside it."""
        if layer != "gold" or version is None or version != self._open:
            return super().read(layer, table, version, row_id)
        names = self.tables[(layer, table)].names
        rows = jdbc.read_table(
            self.spark, self.connection, self._beside(table, NEXT), self.splits.get((layer, table))
        ).select(*names)
        return rows if row_id is None else rows.withColumn(row_id, F.xxhash64(*names))

    def _swapped(self, suffix: str, aside: str) -> list[str]:
        """Tables with `suffix` become gold, gold gets the suffix `aside`."""
        return [statement for t in GOLD_TABLES for statement in (
            self.dialect.rename.format(table=self.name("gold", t), name=self._plain(t, aside)),
            self.dialect.rename.format(table=self._beside(t, suffix), name=self._plain(t)),
        )]

    def publish(self, layer: str, table: str, version: str) -> None:
        """Let the database check the references, then swap all four names."""
        if layer != "gold" or version != self._open:
            return super().publish(layer, table, version)
        self._execute([
            *(
                self.dialect.reference.format(table=self._beside(t, NEXT), column=c, target=self._beside(to, NEXT))
                for t, c, to in self.references
            ),
            *self._dropped(PREVIOUS), *self._swapped(NEXT, PREVIOUS),
        ])
        self._open = None

    def unpublish(self, layer: str, table: str, version: str) -> None:
        """Back to the tables that the last refresh replaced; its own wait beside them."""
        if layer != "gold":
            return super().unpublish(layer, table, version)
        self._execute([*self._dropped(NEXT), *self._swapped(PREVIOUS, NEXT)])

    def withdraw(self, layer: str, table: str, version: str) -> None:
        if layer != "gold" or version != self._open:
            return super().withdraw(layer, table, version)
        self._execute(self._dropped(NEXT))
        self._open = None
