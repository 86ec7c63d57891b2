from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import is_na_token
from stratalake.operators.columns import numeric_columns, text_columns
from stratalake.operators.medians import median_row
from stratalake.schemas import NA_TOKENS, UNKNOWN_TEXT


def na_tokens(
    df: DataFrame, tokens: Iterable[str] = NA_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn missing-value words of text columns into NULL."""
    chosen = text_columns(df) if columns is None else list(columns)
    words = list(tokens)
    return df.withColumns(
        {c: F.when(~is_na_token(F.col(c), words), F.col(c)) for c in chosen}
    ) if chosen else df


def median_impute(
    df: DataFrame, exclude: Iterable[str] = (), approx: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Fill NULLs (and NaN) of every numeric column with the column's median.

    The medians are one scalar subquery: no join, nothing brought to the caller. A column
    without NULLs is left alone and one without values stays NULL. `measured` may give the rows
    to take the medians of in another form, where df's own would not be reused by Spark.
    """
    columns = numeric_columns(df, exclude)
    if not columns:
        return df
    medians = median_row(
        df if measured is None else measured, columns, only_incomplete=True, approx=approx
    )
    filled = df.withColumn("_medians", medians.select(F.struct(*columns)).scalar())
    types = {f.name: f.dataType for f in df.schema}

    def fill(name: str) -> Column:
        value, median = F.col(name), F.col("_medians").getField(name)
        if isinstance(types[name], (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        return F.coalesce(value, median)

    return filled.withColumns({c: fill(c) for c in columns}).drop("_medians")


def constant_impute(
    df: DataFrame, value: str = UNKNOWN_TEXT, columns: Sequence[str] | None = None
) -> DataFrame:
    chosen = text_columns(df) if columns is None else list(columns)
    return df.fillna(value, subset=chosen) if chosen else df
