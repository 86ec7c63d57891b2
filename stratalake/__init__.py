"""Medallion churn analytics as composable Spark DataFrame operators."""

from stratalake.context import RunContext

__all__ = ["RunContext"]
