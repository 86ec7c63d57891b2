"""What tasks in Python need: this package, and batches of bounded size."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


# Rows of whole texts in an Arrow batch, which the executor and its worker hold several times over.
BATCH_ROWS = 2000


def reach_workers(spark: SparkSession) -> None:
    """Name this checkout in the workers' PYTHONPATH, for sessions started from elsewhere, and keep
    Arrow batches small.

    Where executors do not share the folder, ship the package with --py-files as usual.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([*filter(None, known), root])
