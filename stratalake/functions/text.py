from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.schemas import NA_TOKENS


def normalize_text(value: Column) -> Column:
    """Lower case without leading and trailing spaces (the space character only)."""
    return F.trim(F.lower(value))


def is_na_token(value: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Exact match against the missing-value vocabulary."""
    return value.isin(list(tokens))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
