from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_exact(
    df: DataFrame, copies: str | None = None, keep_min: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct row, NULLs being equal to each other.

    `copies` names an extra column with the number of input rows each output row stands for, so
    that one aggregate serves both the rows and the duplicate count. Columns in `keep_min` are
    not compared; the smallest value is kept. Copies collapse map-side, so a row repeated very
    often reaches the shuffle once per task.
    """
    keys = [c for c in df.columns if c not in keep_min]
    aggregates = [F.min(c).alias(c) for c in keep_min]
    if copies is not None:
        aggregates.append(F.count(F.lit(1)).alias(copies))
    if not aggregates:
        return df.dropDuplicates()
    order = [*df.columns, *([copies] if copies else [])]
    return df.groupBy(*keys).agg(*aggregates).select(*order)


def duplicates_removed(df: DataFrame) -> DataFrame:
    """One row: rows read, rows kept and their difference."""
    return dedupe_exact(df, copies="_copies").agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
    ).withColumn("duplicates_removed", F.col("rows_read") - F.col("rows_kept"))
