"""CSV scan: header, comma, missing-value words, then declared or inferred types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.impute import na_tokens
from stratalake.schemas import LONG_ROW_COLUMN, NA_TOKENS, RAW, RAW_VARIANT_TYPES

RAW_TYPES: dict[str, T.DataType] = {
    **{f.name.lower(): f.dataType for f in RAW}, **RAW_VARIANT_TYPES,
}
_INFERRED_NUMBER = T.DecimalType(18, 2)
_CORRUPT = "_corrupt_record"

# A number as text. Its digits are judged as written: a cast would round them first.
_SIGN = r"^\s*[+-]?"
_EXPONENT = _SIGN + r"(?=\.?\d)(\d*)\.?(\d*)[eE]([+-]?\d{1,3})\s*$"


def _fits_scale(text: Column, scale: int) -> Column:
    """Whether a number has no digit but zeros beyond `scale` decimals."""
    if scale == 0:
        plain = _SIGN + r"\d+(?:\.0*)?\s*$"
    else:
        plain = _SIGN + rf"(?:\d+\.?|\d*\.\d{{1,{scale}}}0*)\s*$"
    # With an exponent: the decimals written, less zeros at the end, moved by the exponent.
    whole, decimals, exponent = (F.regexp_extract(text, _EXPONENT, i) for i in (1, 2, 3))
    digits = F.concat(whole, decimals)
    zeros = F.length(digits) - F.length(F.regexp_replace(digits, "0+$", ""))
    needed = F.length(decimals) - zeros - exponent.try_cast("int")
    return text.rlike(plain) | text.rlike(_EXPONENT) & ((needed <= scale) | ~digits.rlike("[1-9]"))


def _parsed(column: Column, dtype: T.DataType) -> Column:
    """Text to `dtype`, NULL if it is not one or has more decimals than it.

    Numbers may be written with an exponent: 5e3 and 1.5e3 are whole, 2e-1 has one decimal.
    """
    value = column.try_cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return F.when(_fits_scale(column, dtype.scale), value)
    if isinstance(dtype, T.IntegralType):
        # Only text that is not plainly whole pays for the second look. Spark casts 5.7 to 5.
        plain = column.rlike(_SIGN + r"\d+\s*$")
        written = F.when(_fits_scale(column, 0), column.try_cast("decimal(38,0)").try_cast(dtype))
        return F.when(plain, value).otherwise(written)
    return value


def typed(
    df: DataFrame, types: Mapping[str, T.DataType], on_bad: str = "error"
) -> DataFrame:
    """Convert text columns to their types; columns not listed stay text.

    Text that does not parse, or has more decimals than its type, fails the job (`error`) or
    becomes NULL (`null`).
    """
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be error or null, not {on_bad!r}")
    out = []
    for name in df.columns:
        text, dtype = F.col(name), types.get(name.lower(), T.StringType())
        if isinstance(dtype, T.StringType):
            out.append(text)
            continue
        value = _parsed(text, dtype)
        if on_bad == "error":
            message = F.concat(F.lit(f"{name}: not {dtype.simpleString()}: "), text)
            value = F.when(
                text.isNotNull() & value.isNull(), F.raise_error(message).cast(dtype)
            ).otherwise(value)
        out.append(value.alias(name))
    return df.select(*out)


def _fields(record: Column) -> Column:
    """Number of fields of a record: quoted up to their closing quote, else up to a comma."""
    field = r'(?:^|,)(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'
    return F.regexp_count(record, F.lit(field))


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """Types of text columns judged over every value, in one scan.

    A column whose non-null values are all whole numbers is INT (BIGINT if they need it), all
    numbers DECIMAL(18,2), or DOUBLE when they have more digits; the rest stays text.
    Only one row of counts per column set is read back.
    """
    def fits(name: str, dtype: T.DataType) -> Column:
        return F.count(_parsed(F.col(name), dtype))

    number = _INFERRED_NUMBER
    counts = df.agg(*[
        F.struct(
            F.count(c).alias("values"),
            fits(c, T.IntegerType()).alias("int"),
            fits(c, T.LongType()).alias("long"),
            fits(c, number).alias("number"),
            fits(c, T.DoubleType()).alias("double"),
        ).alias(c)
        for c in df.columns
    ]).first()
    types: dict[str, T.DataType] = {}
    for name in df.columns:
        seen = counts[name]
        if seen["values"] == 0:
            types[name.lower()] = T.StringType()
        elif seen["int"] == seen["values"]:
            types[name.lower()] = T.IntegerType()
        elif seen["long"] == seen["values"]:
            types[name.lower()] = T.LongType()
        elif seen["number"] == seen["values"]:
            types[name.lower()] = number
        elif seen["double"] == seen["values"]:
            types[name.lower()] = T.DoubleType()
        else:
            types[name.lower()] = T.StringType()
    return types


def read_csv_raw(
    spark: SparkSession, path: str | list[str],
    types: Mapping[str, T.DataType] | str = RAW_TYPES,
    tokens: Iterable[str] = NA_TOKENS, on_bad: str = "error", file_column: str | None = None,
    multi_line: bool = False, long_rows: str = LONG_ROW_COLUMN,
) -> DataFrame:
    """Scan CSV files that share one header.

    Column names come from the header, types from `types` by lower-cased name, or from the
    values with `types="infer"` (one more scan). `file_column` adds the name of each row's file.
    `multi_line` allows line breaks inside quotes, at the price of one task per file.

    A row with fewer fields than the header has missing values. One with more fails the job
    (`on_bad="error"`); with `on_bad="null"` it is kept and its whole text stands in the column
    named by `long_rows`, which is NULL for all other rows.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    header = reader.csv(path).schema
    if _CORRUPT in header.names or on_bad == "null" and long_rows in header.names:
        raise ValueError(f"the header has a column {_CORRUPT} or {long_rows} of its own")
    # Every file's header is compared with the first one's instead of being trusted.
    shown = T.StructType([*header.fields, T.StructField(_CORRUPT, T.StringType())])
    text = (
        reader.options(enforceSchema=False, columnNameOfCorruptRecord=_CORRUPT).schema(shown).csv(path)
    )
    # Set for rows of any other length than the header's, and for nothing else: all is text.
    # But only where every column is read: a pruned scan splits no more than it needs, and says
    # nothing. So all are looked at, whatever is selected later.
    every = F.concat_ws("", *[F.col(f"`{name}`") for name in header.names])
    is_long = (_fields(F.col(_CORRUPT)) > len(header)) & (F.length(every) >= 0)
    cleaned = na_tokens(text.select(
        "*", *([F.col("_metadata.file_name").alias(file_column)] if file_column else [])
    ), tokens, columns=header.names)
    if on_bad == "error":
        message = F.concat(F.lit(f"more than {len(header)} fields: "), F.col(_CORRUPT))
        refused = F.when(is_long, F.raise_error(message).cast("boolean")).otherwise(True)
        # In a filter, so that it holds whichever columns are read.
        cleaned = cleaned.where(refused).drop(_CORRUPT)
    else:
        cleaned = cleaned.withColumn(long_rows, F.when(is_long, F.col(_CORRUPT))).drop(_CORRUPT)
    if types == "infer":
        types = infer_types(cleaned.select(*header.names))
    return typed(cleaned, types, on_bad)
