"""Exact duplicates across loads, by a ledger of the rows seen so far.

The ledger holds a 128-bit digest for each distinct row that was ever accepted, in a fixed number
of hash buckets. A load shuffles its own rows once, into the same buckets; the ledger is read
bucket by bucket and is not shuffled, however large it has become. Only digests are kept, so its
size is 16 bytes a row and the rows themselves are not read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.dedupe import dedupe_exact
from stratalake.sources.filesystem import child_names, exists, remove_tree, touch
from stratalake.sources.staging import Staging

_DIGEST = "_digest"


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of a row's values: equal for rows that a GROUP BY takes for equal, NULLs included."""
    def text(name: str) -> Column:
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            # One zero, and one text for it.
            value = value + F.lit(0.0)
        return value.alias(name)

    # Field by field, so that no two rows share a text; NULL fields are written out.
    row = F.to_json(F.struct(*map(text, columns)), {"ignoreNullFields": "false"})
    return F.substring(F.unhex(F.sha2(row, 256)), 1, 16)


class RowLedger:
    """`folder` holds one sub-folder per load, which counts once it is marked."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 256):
        if buckets < 1:
            raise ValueError("buckets must be positive")
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def loads(self) -> list[str]:
        """Committed loads, oldest first."""
        names = child_names(self.spark, self.folder)
        return [n for n in names if exists(self.spark, f"{self.folder}/{n}/_DONE")]

    def _table(self, load: str) -> str:
        """A catalog table over one load's digests, so that its buckets are known to joins."""
        name = f"ledger_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.folder}/{load}').hex}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_DIGEST} BINARY) USING parquet "
            f"CLUSTERED BY ({_DIGEST}) SORTED BY ({_DIGEST}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder}/{load}/digests'"
        )
        return name

    def seen(self) -> list[DataFrame]:
        """The digests of each committed load."""
        return [self.spark.table(self._table(load)) for load in self.loads()]

    def accept(
        self, df: DataFrame, load: str, staging: Staging, copies: str | None = None,
        keep_min: Sequence[str] = (),
    ) -> DataFrame:
        """The rows of `df` that no earlier load had, one each; they are in the ledger afterwards.

        `copies` and `keep_min` are as in dedupe_exact. A load that is repeated under its name
        replaces what an unfinished one left; one that was committed is refused.
        """
        if load in self.loads():
            raise ValueError(f"load {load!r} is in the ledger already")
        target = f"{self.folder}/{load}"
        remove_tree(self.spark, target)
        distinct = dedupe_exact(df, copies, keep_min)
        compared = [c for c in df.columns if c not in keep_min]
        fresh = distinct.withColumn(_DIGEST, row_digest(df, compared)).repartition(self.buckets, _DIGEST)
        for digests in self.seen():
            fresh = fresh.join(digests.hint("merge"), _DIGEST, "left_anti")
        # Written first: what is handed on and what is remembered are the same rows.
        accepted = staging.table(fresh)
        name = self._table(load)
        accepted.select(_DIGEST).repartition(self.buckets, _DIGEST).write.insertInto(name)
        touch(self.spark, f"{target}/_DONE")
        return accepted.drop(_DIGEST)

    def compact(self, load: str) -> None:
        """All committed loads as one, under the name `load`, which must be new."""
        earlier = self.loads()
        if load in earlier:
            raise ValueError(f"load {load!r} is in the ledger already")
        remove_tree(self.spark, f"{self.folder}/{load}")
        whole = None
        for digests in self.seen():
            whole = digests if whole is None else whole.unionByName(digests)
        if whole is None:
            return
        whole.repartition(self.buckets, _DIGEST).write.insertInto(self._table(load))
        # Digests of loads that are still there twice are harmless: they are only looked up.
        touch(self.spark, f"{self.folder}/{load}/_DONE")
        for old in earlier:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
            remove_tree(self.spark, f"{self.folder}/{old}")
