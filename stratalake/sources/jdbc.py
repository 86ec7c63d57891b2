"""Relational tables through Spark's JDBC source and sink.

Addresses and credentials are the caller's options (url, driver, user, password); none are kept
here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_REQUIRED = ("url",)


@dataclass(frozen=True)
class KeySplit:
    """Read a table in `parts` ranges of a numeric or date column instead of one task.

    The bounds only shape the ranges; rows outside them are read by the first and last one.
    """

    column: str
    lower: int | str
    upper: int | str
    parts: int

    def options(self) -> dict[str, str]:
        if self.parts < 1:
            raise ValueError("parts must be positive")
        return {
            "partitionColumn": self.column, "lowerBound": str(self.lower),
            "upperBound": str(self.upper), "numPartitions": str(self.parts),
        }


def _checked(connection: Mapping[str, str]) -> dict[str, str]:
    missing = [key for key in _REQUIRED if not connection.get(key)]
    if missing:
        raise ValueError(f"connection options missing: {missing}")
    return dict(connection)


def read_options(
    connection: Mapping[str, str], table: str, split: KeySplit | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    options = _checked(connection) | {"dbtable": table, "fetchsize": str(fetch_rows)}
    return options | (split.options() if split else {})


def write_options(
    connection: Mapping[str, str], table: str, batch_rows: int = 1000,
    connections: int | None = None,
) -> dict[str, str]:
    """`truncate` keeps the target's columns, keys and indexes when it is overwritten."""
    options = _checked(connection) | {
        "dbtable": table, "truncate": "true", "batchsize": str(batch_rows),
    }
    return options | ({"numPartitions": str(connections)} if connections else {})


def read_table(
    spark: SparkSession, connection: Mapping[str, str], table: str,
    split: KeySplit | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, table, split)).load()


def write_table(
    df: DataFrame, connection: Mapping[str, str], table: str, mode: str = "overwrite",
    batch_rows: int = 1000, connections: int | None = None,
) -> None:
    """Replace (or append to) a table in batches, over at most `connections` connections."""
    options = write_options(connection, table, batch_rows, connections)
    df.write.format("jdbc").options(**options).mode(mode).save()


def execute(spark: SparkSession, connection: Mapping[str, str], statements: Sequence[str]) -> None:
    """Run statements on one connection, in one transaction: all of them or none."""
    options = _checked(connection)
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        if name != "url":
            properties.setProperty(name, str(value))
    if options.get("driver"):
        # Makes drivers that came with --jars known to the DriverManager.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    opened = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        run_all(opened, statements)
    finally:
        opened.close()


def run_all(opened, statements: Sequence[str]) -> None:
    """The transaction itself, on an open connection."""
    opened.setAutoCommit(False)
    statement = opened.createStatement()
    try:
        for text in statements:
            statement.execute(text)
        opened.commit()
    except Exception:
        opened.rollback()
        raise
    finally:
        statement.close()


def reset_table(df: DataFrame, connection: Mapping[str, str], table: str) -> None:
    """Empty a table, keeping its definition."""
    write_table(df.limit(0), connection, table)
