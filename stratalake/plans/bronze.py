from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.context import RunContext
from stratalake.functions import base_name
from stratalake.operators.columns import lowercase_names, text_columns
from stratalake.operators.dedupe import dedupe_exact
from stratalake.operators.impute import constant_impute, median_impute
from stratalake.schemas import LONG_ROW_COLUMN


def build_bronze(
    raw: DataFrame, ctx: RunContext, copies: str | None = None, file_column: str | None = None
) -> DataFrame:
    """Raw records without exact duplicates or gaps, stamped with the run.

    Order matters: rows are compared before gaps are filled, so rows that become equal only by
    filling both stay, and the run's columns are neither compared nor filled. `copies` keeps the
    number of raw rows behind each row, for the duplicate count. With `file_column` the source
    file comes from that column (the first by name, if copies lie in several files).
    """
    distinct = dedupe_exact(raw, copies, keep_min=[file_column] if file_column else ())
    technical = {c for c in (copies, file_column, LONG_ROW_COLUMN) if c}
    # Medians and rows come from the same shuffle, provided that both ask it for the same
    # columns: the condition, always true, keeps `copies` from being pruned for the medians.
    measured = distinct.where(F.col(copies) > 0) if copies else distinct
    filled = median_impute(
        distinct, {*ctx.impute_exclude, *technical}, ctx.approx_median, measured
    )
    filled = constant_impute(
        filled, columns=[c for c in text_columns(filled) if c not in technical]
    )
    source = F.col(file_column) if file_column else base_name(F.lit(ctx.source_file))
    stamped = filled.withColumns({
        "ingestion_timestamp": ctx.now(),
        "source_file": source,
        "pipeline_run_id": F.lit(ctx.run_id),
    })
    if file_column and file_column != "source_file":
        stamped = stamped.drop(file_column)
    return lowercase_names(stamped)
