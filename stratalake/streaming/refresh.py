"""Periodic refresh of silver from new bronze files only.

Silver is row-local, so the batch builder serves a stream unchanged. Bronze medians and dense
gold keys depend on the whole table and are refreshed by run_layers.

The source is a folder to which new bronze files are added. The versions of a LayerStore are no
such folder: each is a full rewrite, and streaming over all of them would append every record
again. Which files were checked is remembered in a manifest beside the stream's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.context import RunContext
from stratalake.operators.columns import conform
from stratalake.plans.silver import build_silver
from stratalake.schemas import SILVER
from stratalake.streaming.manifest import FileManifest, SchemaDrift, columns_of

__all__ = ["SchemaDrift", "refresh_silver", "silver_stream"]


def silver_stream(
    spark: SparkSession, bronze_path: str, ctx: RunContext, schema: T.StructType
) -> DataFrame:
    """Streaming silver records of the files that appear below `bronze_path`, which have `schema`.

    Columns that drifted are kept and find their way to silver as in a batch.
    """
    bronze = spark.readStream.schema(schema).parquet(bronze_path)
    return conform(build_silver(bronze, ctx), SILVER)


def refresh_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, ctx: RunContext,
    schema: T.StructType | None = None,
) -> None:
    """Append the silver records of all files not seen before, then stop.

    Call it as often as a refresh is due; `checkpoint` remembers the files already done, and
    the file sink commits each batch once. A file with other columns than the rest is refused
    before any file of the refresh is read; with a `schema`, files must have exactly its columns.
    Only files that the manifest does not know are opened for that.
    """
    found = FileManifest(spark, f"{checkpoint.rstrip('/')}/manifest").check(bronze_path)
    if found is None:
        found = spark.read.parquet(bronze_path).schema
    if schema is not None and columns_of(found) != columns_of(schema):
        differing = set(columns_of(found).items()) ^ set(columns_of(schema).items())
        raise SchemaDrift(f"{bronze_path}: differs in {sorted(differing)}")
    query = (
        silver_stream(spark, bronze_path, ctx, found)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(silver_path)
    )
    query.awaitTermination()
