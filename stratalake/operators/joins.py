"""Natural key to surrogate key lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.staging import Staging


BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Measure whether a table is small enough to be sent to every executor.

    One distributed aggregate over the table: call it on a written table, with the columns that
    would be sent.
    """
    return all_fit_broadcast([df], max_rows, max_bytes)[0]


def _measure(df: DataFrame, number: int) -> DataFrame:
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns],
    )
    return df.agg(
        F.lit(number).alias("number"), F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(width), F.lit(0)).alias("size"),
    )


def all_fit_broadcast(
    tables: Sequence[DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> list[bool]:
    """`fits_broadcast` of several tables, measured in one job."""
    measures = reduce(DataFrame.unionByName, [_measure(t, i) for i, t in enumerate(tables)])
    return [
        row["n"] <= max_rows and row["size"] <= max_bytes
        for row in sorted(measures.collect(), key=lambda row: row["number"])
    ]


def _one_per_key(
    dim: DataFrame, keys: Sequence[str], sk: str, on_conflict: str, prefer: Column | None
) -> DataFrame:
    grouped = dim.groupBy(*keys)
    if on_conflict == "pick":
        if prefer is None:
            raise ValueError("on_conflict='pick' needs `prefer`")
        return grouped.agg(F.max_by(sk, F.struct(prefer, F.col(sk))).alias(sk))
    if on_conflict == "error":
        key = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        refusal = F.raise_error(F.concat(F.lit(f"several {sk} for "), key)).cast("boolean")
        counted = grouped.agg(F.max(sk).alias(sk), F.count(F.lit(1)).alias("_n"))
        # In a filter, so that it also holds where nobody reads the key.
        return counted.where(F.when(F.col("_n") > 1, refusal).otherwise(True)).drop("_n")
    raise ValueError(f"on_conflict must be fanout, error or pick, not {on_conflict!r}")


def lookup_key(
    fact: DataFrame, dim: DataFrame, natural_keys: Sequence[str], sk: str,
    null_safe: bool = False, broadcast: bool = False, on_conflict: str = "fanout",
    prefer: Column | None = None, staging: Staging | None = None,
) -> DataFrame:
    """Add `sk` of the dimension row(s) with the fact's natural key; unmatched facts drop out.

    `broadcast` says that the caller measured the dimension (see `fits_broadcast`). Without it
    both sides are shuffled, and adaptive execution splits the keys that hold too many facts. It
    can do so only where the join reads both shuffles directly: give written tables.
    NULL keys match nothing unless `null_safe`. If a natural key has several dimension rows,
    `fanout` gives one row for each, `error` fails the job and `pick` takes the row with the
    greatest `prefer`; the last two reduce the dimension first, into `staging` if given.
    """
    keys = list(natural_keys)
    if on_conflict == "fanout":
        side = dim.select(*keys, sk)
    else:
        side = _one_per_key(dim, keys, sk, on_conflict, prefer)
        side = staging.table(side) if staging and not broadcast else side
    if not null_safe:
        hinted = F.broadcast(side) if broadcast else side
        return fact.join(hinted, keys).select(*fact.columns, sk)

    side = side.withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_dim_{k}")) for k in keys])
    return fact.join(F.broadcast(side) if broadcast else side, same).select(*fact.columns, sk)
