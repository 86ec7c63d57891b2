from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(
    numerator: Column, denominator: Column, dtype: str = "decimal(10,2)", scale: int = 2,
    default: int = 0,
) -> Column:
    """numerator / denominator, half-up to `scale`; `default` unless the denominator is > 0."""
    positive = F.when(denominator > 0, denominator)
    return (
        F.when(positive.isNull(), F.lit(default).cast(dtype))
        .otherwise(F.round(numerator / positive, scale).cast(dtype))
    )


def rounded_product(a: Column, b: Column, dtype: str = "decimal(12,2)", scale: int = 2) -> Column:
    """a * b, half-up to `scale`; NULL if either factor is."""
    return F.round(a * b, scale).cast(dtype)
