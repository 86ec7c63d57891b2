from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rate_report(
    fact: DataFrame, dims: Mapping[str, DataFrame], group_by: Sequence[str], flag: str,
    counted: str, count_as: str, rate_as: str,
) -> DataFrame:
    """Non-null count and percentage of flagged facts per dimension attributes, highest first.

    `dims` maps each surrogate key of the fact to its dimension. Facts are added up per
    surrogate key first, so the joins see one row per key combination and not per fact.
    """
    sums = fact.groupBy(*dims).agg(
        F.count(counted).alias("_counted"), F.count_if(flag).alias("_flagged"),
        F.count(F.lit(1)).alias("_rows"),
    )
    for sk, dim in dims.items():
        attributes = [c for c in group_by if c in dim.columns]
        sums = sums.join(dim.select(sk, *attributes), sk)
    rate = F.sum("_flagged").cast("double") / F.sum("_rows") * 100
    return (
        sums.groupBy(*group_by)
        .agg(F.sum("_counted").alias(count_as), rate.alias(rate_as))
        .orderBy(F.desc(rate_as), *group_by)
    )
