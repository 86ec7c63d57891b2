"""Tables written side by side: bucketed alike, so that later joins and checks shuffle nothing.

Two tables that are often matched are written once by a slot, a 64-bit hash of their common key.
Every later lookup, existence check and distinct over them reads matching buckets in one task. A
key of more than `hot_rows` rows gets as many slots as it needs: its rows are dealt over them by
`spread_by`, and the other table's row is written into each. Keys are matched NULL-safely, and
rows of different keys that share a slot are told apart by the keys themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import fits_broadcast
from stratalake.sources.staging import Staging

SLOT = "_slot"


def _hash(keys: Sequence[str]) -> Column:
    """Hash of a key. NULL and the columns around it do not stand for one another."""
    return F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """NULL-safe equality, as a range: an equality would join the slot as a key to shuffle by."""
    value = F.struct(*[F.col(c) for c in left])
    other = F.struct(*[F.col(c) for c in right])
    return (value >= other) & (value <= other)


def _hot(many: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys of more than `hot_rows` rows, and the number of slots they need."""
    sized = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return sized.select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"),
    )


@dataclass(frozen=True)
class CoLocated:
    """Layout shared by tables: key, buckets, and the slots of keys with very many rows."""

    keys: tuple[str, ...]
    types: tuple[T.DataType, ...]
    buckets: int
    hot: DataFrame
    small: bool
    staging: Staging

    def renamed(self, *keys: str) -> CoLocated:
        """The same layout for a table that has the key under other names."""
        names = {f"_hot_{old}": f"_hot_{new}" for old, new in zip(self.keys, keys)}
        return replace(self, keys=tuple(keys), hot=self.hot.withColumnsRenamed(names))

    def _with_parts(self, df: DataFrame) -> DataFrame:
        types = tuple(df.schema[k].dataType for k in self.keys)
        if types != self.types:
            # Equal numbers of different types have different hashes.
            raise TypeError(f"the layout's keys are {self.types}, not {types}")
        hot = F.broadcast(self.hot) if self.small else self.hot
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in self.keys]
        found = df.join(hot, same, "left")
        return found.drop(*[f"_hot_{k}" for k in self.keys])

    def _write(self, df: DataFrame, part: Column) -> DataFrame:
        slot = F.when(F.col("_parts").isNull(), _hash(self.keys)).otherwise(
            F.xxhash64(_hash(self.keys), part)
        )
        laid_out = df.withColumn(SLOT, slot).drop("_parts", "_part")
        path = self.staging.folder()
        name = f"colocated_{path.rsplit('/', 1)[-1]}"
        spark = df.sparkSession
        # One file to a bucket.
        laid_out.repartition(self.buckets, SLOT).write.option("path", path).bucketBy(
            self.buckets, SLOT
        ).sortBy(SLOT).saveAsTable(name)
        table = spark.table(name)
        # The catalog's entry only told the reader of the buckets; the files are the staging's.
        spark.sql(f"DROP TABLE {name}")
        return table

    def many(self, df: DataFrame, spread_by: Sequence[str] = ()) -> DataFrame:
        """Write the table whose keys repeat. `spread_by` tells the rows of one key apart; by
        default all columns do, which leaves rows equal in everything together."""
        parted = self._with_parts(df)
        part = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.col("_parts"))
        return self._write(parted, part.cast("int"))

    def one(self, df: DataFrame) -> DataFrame:
        """Write the table that is looked up, its hot keys once into each of their slots."""
        last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
        parted = self._with_parts(df).withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        return self._write(parted, F.col("_part"))


def co_locate(
    many: DataFrame, keys: Sequence[str], staging: Staging, buckets: int,
    hot_rows: int = 1_000_000,
) -> CoLocated:
    """A layout for tables matched on `keys`, measured on the one in which they repeat.

    Take about as many buckets as the larger table has 128 MB; all tables of one layout have
    the same number. There is at most one hot key for each `hot_rows` rows; the list of them is
    broadcast only if it is small.
    """
    if buckets < 1 or hot_rows < 1:
        raise ValueError("buckets and hot_rows must be positive")
    hot = staging.table(_hot(many, keys, hot_rows))
    types = tuple(many.schema[k].dataType for k in keys)
    return CoLocated(tuple(keys), types, buckets, hot, fits_broadcast(hot), staging)


def _other_side(one: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    side = one.select(
        F.col(SLOT).alias("_other_slot"), *[F.col(k).alias(f"_other_{k}") for k in keys], *more
    )
    # Bucket against bucket: the looked-up table may be large, and is never broadcast.
    return side.hint("merge")


def co_lookup(
    many: DataFrame, one: DataFrame, keys: Sequence[str], sk: str,
    one_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Add `sk` of the row(s) with the same key, NULLs included; unmatched rows drop out."""
    names = list(one_keys or keys)
    side = _other_side(one, names, sk)
    same = _same(keys, [f"_other_{k}" for k in names])
    return many.join(side, (F.col(SLOT) == F.col("_other_slot")) & same).select(*many.columns, sk)


def co_distinct(many: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a co-located table, each at most once in a slot: nothing is shuffled, and a
    distinct over the result moves one row of a key, or one for each of a hot key's slots."""
    return many.groupBy(SLOT, *keys).agg(F.lit(1).alias("_")).drop("_", SLOT)


def co_orphans(
    many: DataFrame, one: DataFrame, keys: Sequence[str], one_keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose key, if it has no NULL, is not in the other table."""
    names = list(one_keys or keys)
    side = _other_side(one, names)
    same = _same(keys, [f"_other_{k}" for k in names])
    return many.dropna(subset=list(keys)).join(
        side, (F.col(SLOT) == F.col("_other_slot")) & same, "left_anti"
    )


def check_co_located_key(
    many: DataFrame, table: str, key: str, one: DataFrame, one_key: str
) -> DataFrame:
    """`check_foreign_key` of co-located tables: counted bucket by bucket."""
    orphans = co_orphans(many, one, [key], [one_key])
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"foreign_key({key})").alias("check"), F.lit(table).alias("table"), "violations"
    )
