from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.context import RunContext
from stratalake.functions import pseudonymize, safe_ratio
from stratalake.operators.columns import (
    fallback_column,
    lowercase_names,
    normalize_columns,
    rename_variants,
    select_available,
)
from stratalake.operators.quality import completeness_score
from stratalake.schemas import (
    SILVER,
    SILVER_FALLBACKS,
    SILVER_TEXT_COLUMNS,
    SILVER_VARIANTS,
)


def build_silver(bronze: DataFrame, ctx: RunContext, on_collision: str = "coalesce") -> DataFrame:
    """Bronze records under stable names, pseudonymised, normalised, scored.

    Everything is row-local: one projection over the scan, no shuffle, and usable on a stream.
    The raw customer id does not pass beyond this step.
    """
    df = rename_variants(lowercase_names(bronze), SILVER_VARIANTS, on_collision)
    for name, fallbacks in SILVER_FALLBACKS.items():
        df = fallback_column(df, name, fallbacks, T.IntegerType())

    key = F.col("customerid")
    if isinstance(df.schema["customerid"].dataType, T.FractionalType):
        # The digest is taken of the id's text, which must not depend on how it was stored.
        key = key.cast("bigint")
    df = df.withColumn("customer_id_anonymized", pseudonymize(key, ctx.hash_length, ctx.hash_salt))
    df = normalize_columns(df, SILVER_TEXT_COLUMNS)
    df = df.withColumn("avg_monthly_spend", safe_ratio(F.col("total_charges"), F.col("tenure")))
    df = completeness_score(df)
    df = df.withColumns({
        "transformation_timestamp": ctx.now(), "source_pipeline": F.lit(ctx.source_name),
    })
    return select_available(df, SILVER.names)
