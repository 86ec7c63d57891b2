from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_attributes(df: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """Distinct combinations of the columns in `attributes` (name in df -> name in the result)."""
    return df.select(*[F.col(c).alias(name) for c, name in attributes.items()]).distinct()
