"""Constraint checks as reports: DataFrame(check, table, violations). A pass is 0 violations."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """At least one check of a report found violations."""


def _row(df: DataFrame, check: str, table: str, violations: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        violations.cast("bigint").alias("violations"),
    )


def _count_each(df: DataFrame, table: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One scan that counts the rows meeting each condition, one result row per condition."""
    if not conditions:
        raise ValueError(f"no checks for {table}")
    counts = df.agg(*[F.count_if(c).alias(f"v{i}") for i, c in enumerate(conditions.values())])
    rows = F.array(*[
        F.struct(
            F.lit(check).alias("check"), F.lit(table).alias("table"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, check in enumerate(conditions)
    ])
    return counts.select(F.inline(rows))


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    """One violation for a table without rows. Reads a single row."""
    return _row(
        df.limit(1).agg(F.count(F.lit(1)).alias("n")), "not_empty", table,
        F.when(F.col("n") == 0, 1).otherwise(0),
    )


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once. NULL keys count like any other."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return _row(
        repeated.agg(F.count(F.lit(1)).alias("n")), f"unique({','.join(keys)})", table, F.col("n")
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return check_columns(df, table, required=columns)


def check_foreign_key(
    fact: DataFrame, table: str, column: str, dim: DataFrame, dim_column: str
) -> DataFrame:
    """Number of fact rows whose non-null key has no dimension row.

    Facts are counted per key before the join, so that keys, not rows, are shuffled.
    """
    used = (
        fact.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    )
    known = dim.select(F.col(dim_column).alias("_known"))
    orphans = used.join(known, F.col("_key") == F.col("_known"), "left_anti")
    return _row(
        orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")),
        f"foreign_key({column})", table, F.col("n"),
    )


def _outside(column: str, limit: int | tuple[int, int]) -> Column:
    value = F.col(column)
    if isinstance(limit, int):
        return F.length(value.cast("string")) > limit
    precision, scale = limit
    return value.isNotNull() & value.try_cast(f"decimal({precision},{scale})").isNull()


def _domain_name(column: str, limit: int | tuple[int, int]) -> str:
    kind = f"text({limit})" if isinstance(limit, int) else f"numeric({limit[0]},{limit[1]})"
    return f"domain({column} {kind})"


def check_domain(
    df: DataFrame, table: str, limits: Mapping[str, int | tuple[int, int]]
) -> DataFrame:
    """Rows with text longer than the declared length or numbers wider than (precision, scale)."""
    return check_columns(df, table, limits=limits)


def check_columns(
    df: DataFrame, table: str, required: Sequence[str] = (),
    limits: Mapping[str, int | tuple[int, int]] | None = None,
) -> DataFrame:
    """Both kinds of column check in one scan: NULLs in `required`, values beyond `limits`."""
    conditions = {f"not_null({c})": F.col(c).isNull() for c in required}
    conditions |= {_domain_name(c, limit): _outside(c, limit) for c, limit in (limits or {}).items()}
    return _count_each(df, table, conditions)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def warn(report: DataFrame) -> None:
    """Log the failed checks of a report."""
    for r in report.where("violations > 0").collect():
        logging.getLogger(__name__).warning(
            "%s: %s has %d violations", r["table"], r["check"], r["violations"]
        )


def require(report: DataFrame, warn_only: Sequence[str] = ()) -> list:
    """Raise if a check failed; give back the report's rows, one per check.

    Checks whose name is in `warn_only` are reported without failing the run.
    """
    rows = report.collect()
    failed = [r for r in rows if r["violations"] and r["check"] not in warn_only]
    if failed:
        raise ConstraintViolation(
            "; ".join(f"{r['table']}: {r['check']} has {r['violations']} violations" for r in failed)
        )
    return rows
