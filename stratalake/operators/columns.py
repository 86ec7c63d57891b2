"""Column naming, schema drift and projections. Decided on the schema, never on rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import normalize_text


def lowercase_names(df: DataFrame) -> DataFrame:
    names = [name.lower() for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"column names equal but for their case: {clashes}")
    return df.toDF(*names)


def rename_variants(
    df: DataFrame, variants: Mapping[str, Sequence[str]], on_collision: str = "coalesce"
) -> DataFrame:
    """Give each target column the content of whichever of its variants is present.

    Absent variants are skipped. If several of them (or the target itself and a variant) are
    present, `coalesce` keeps the first non-null value in the listed order and `error` refuses.
    Names are compared without regard to case.
    """
    if on_collision not in ("coalesce", "error"):
        raise ValueError(f"on_collision must be coalesce or error, not {on_collision!r}")
    actual = {name.lower(): name for name in df.columns}
    target_of: dict[str, str] = {}
    sources: dict[str, list[str]] = {}
    for target, listed in variants.items():
        present = [actual[v.lower()] for v in (target, *listed) if v.lower() in actual]
        if len(present) > 1 and on_collision == "error":
            raise ValueError(f"{target!r} is present as {present}")
        sources[target] = present
        target_of.update({name: target for name in present})

    out, done = [], set()
    for name in df.columns:
        target = target_of.get(name)
        if target is None:
            out.append(F.col(name))
        elif target not in done:
            out.append(F.coalesce(*map(F.col, sources[target])).alias(target))
            done.add(target)
    return df.select(*out)


def fallback_column(
    df: DataFrame, name: str, fallbacks: Sequence[str], dtype: T.DataType
) -> DataFrame:
    """Provide `name` from the first present fallback (renaming it), else as typed NULLs."""
    actual = {c.lower(): c for c in df.columns}
    if name.lower() in actual:
        return df
    for candidate in fallbacks:
        if candidate.lower() in actual:
            return df.withColumnRenamed(actual[candidate.lower()], name)
    return df.withColumn(name, F.lit(None).cast(dtype))


def apply_to_present(
    df: DataFrame, columns: Iterable[str], fn: Callable[[Column], Column]
) -> DataFrame:
    """Replace each listed column that exists by `fn` of it, all in one projection."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: fn(F.col(c)) for c in present}) if present else df


def normalize_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return apply_to_present(df, columns, normalize_text)


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    left_out = {name.lower() for name in exclude}
    return [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name.lower() not in left_out
    ]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
