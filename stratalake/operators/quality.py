from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.schemas import SCORE


def completeness_score(
    df: DataFrame, columns: Sequence[str] | None = None, out: str = "data_quality_score"
) -> DataFrame:
    """Share of non-null values per row over `columns` (default: all), two decimals."""
    scored = df.columns if columns is None else list(columns)
    filled = reduce(add, [F.col(c).isNotNull().cast("int") for c in scored])
    # Only len(scored) + 1 scores exist, so they are worked out once.
    scores = [
        F.lit((Decimal(n) / len(scored)).quantize(Decimal("0.01"), ROUND_HALF_UP)).cast(SCORE)
        for n in range(len(scored) + 1)
    ]
    return df.withColumn(out, F.array(*scores)[filled])
