"""Lookup tables and rules written as CASE expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_rules(rules: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """First rule whose condition is true; a NULL condition does not match."""
    if not rules:
        return F.lit(default)
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def bucketize(value: Column, bands: Sequence[tuple[Any, Any]], default: Any) -> Column:
    """Label of the first band whose inclusive upper edge is not exceeded (edges ascending)."""
    edges = [edge for edge, _ in bands]
    if edges != sorted(edges):
        raise ValueError(f"band edges must ascend: {edges}")
    return case_rules([(value <= edge, label) for edge, label in bands], default)


def map_values(value: Column, mapping: Mapping[Any, Any], default: Any) -> Column:
    """Exact-match value map; anything else, NULL included, takes the default."""
    return case_rules([(value == key, mapped) for key, mapped in mapping.items()], default)


def flag_equals(value: Column, true_value: str) -> Column:
    """True where the text equals `true_value`, false elsewhere and for NULL."""
    return F.coalesce(value == true_value, F.lit(False))
