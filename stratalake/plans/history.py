"""Customer history: what was true of a customer from when to when.

Each snapshot is compared with the open rows by customer: equal attributes leave a row open, other
attributes close it and open the next, a customer that vanished is closed, a new one or one that
came back is opened. One full outer join on the key, on a hash of the attributes; closed rows are
not read for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = ["effective_date", "end_date", "is_current"]


def _hash(columns: Sequence[str]) -> Column:
    """Of values and of where they are missing: a hash alone passes over NULLs."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def one_per_customer(silver: DataFrame, key: str, attributes: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """A customer's row with the greatest `prefer` (then attributes), NULLs counting least. Combined
    before the shuffle, so a customer with very many rows is one per task."""
    order = F.struct(*prefer, *[c for c in attributes if c not in prefer])
    best = silver.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in attributes])


def next_history(
    history: DataFrame | None, snapshot: DataFrame, key: str, attributes: Sequence[str], now: Column
) -> DataFrame:
    """key, attributes, effective_date, end_date, is_current after a snapshot taken at `now`.

    `snapshot` has one row per key. Both should be written tables; the result replaces the history.
    """
    columns = [key, *attributes]
    opened = [now.alias("effective_date"), F.lit(None).cast("timestamp").alias("end_date"), F.lit(True).alias("is_current")]
    if history is None:
        return snapshot.select(*columns, *opened)
    seen = snapshot.select(
        F.col(key).alias("_key"), F.struct(*columns).alias("_new"), _hash(attributes).alias("_new_hash")
    )
    current = history.where("is_current").select(
        F.col(key).alias("_old_key"), F.struct(*columns, *SPAN).alias("_old"), _hash(attributes).alias("_old_hash")
    )
    met = current.join(seen, F.col("_old_key") == F.col("_key"), "full_outer")
    unchanged = F.col("_old_hash").eqNullSafe(F.col("_new_hash")) & F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def kept(end: Column, is_current: Column) -> Column:
        return F.struct(
            *[F.col(f"_old.{c}").alias(c) for c in columns], F.col("_old.effective_date").alias("effective_date"),
            end.alias("end_date"), is_current.alias("is_current"),
        )

    nothing = F.lit(None).cast("timestamp")
    closed = F.when(F.col("_old").isNotNull(), F.when(
        unchanged, kept(nothing, F.lit(True))).otherwise(kept(now, F.lit(False)))
    )
    fresh = F.when(F.col("_new").isNotNull() & ~unchanged, F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns], *opened
    ))
    rows = met.select(F.explode(F.array_compact(F.array(closed, fresh))).alias("_row")).select("_row.*")
    return history.where(~F.col("is_current")).select(*columns, *SPAN).unionByName(rows)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The rows that were true at a moment: from their effective date until before their end."""
    return history.where((F.col("effective_date") <= at) & (F.col("end_date").isNull() | (at < F.col("end_date"))))
