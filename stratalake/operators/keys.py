"""Dense 1..n surrogate keys without moving the table to one task.

Numbering rows needs only how many rows lie in the parts before one's own: number inside each
part, count the parts, add up the counts. What differs is how the parts are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import fits_broadcast
from stratalake.sources.staging import Staging

# monotonically_increasing_id() is documented as partition number, then 33 bits of row number.
_ROW_BITS = 33


def _offsets(sizes: DataFrame, part: str) -> DataFrame:
    """Rows before each part. One task, but one row per part."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        F.col(part).alias("_offset_of"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
    )


def key_by_hex_prefix(
    df: DataFrame, order_by: Sequence[str], out: str, digits: int = 4
) -> DataFrame:
    """Number rows in the order of `order_by`, whose first column is a lower-case hex digest.

    Parts are the 16**digits prefixes (plus one for NULL), which sort like the digests and are
    evenly filled because digests are. Nothing is staged, and the plan stays lazy. The broadcast
    offsets have 16**digits + 1 rows at most.

    Rows sharing one digest stay in one part, so use this on rows already distinct on
    `order_by`; use `key_by_range` for rows that repeat a key without bound.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    parted = df.withColumn(
        "_part", F.coalesce(F.substring(F.col(order_by[0]), 1, digits), F.lit(""))
    )
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))
    offsets = _offsets(sizes, "_part")
    return (
        parted.withColumn("_place", place)
        .join(F.broadcast(offsets), F.col("_part") == F.col("_offset_of"))
        .select(*df.columns, (F.col("_offset") + F.col("_place")).alias(out))
    )


def key_by_range(
    df: DataFrame, order_by: Sequence[str], out: str, staging: Staging,
    spread_by: Sequence[Column | str] = (), drop: Sequence[str] = (),
) -> DataFrame:
    """Number rows in the order of `order_by`, whatever the keys look like.

    The table is range-partitioned, sorted and staged once; the staged partition and row numbers
    give the key. Range bounds are sampled, hence the staging: both the sizes and the rows are
    read from the same written layout. Rows equal on `order_by` may be cut across partitions if
    `spread_by` tells them apart, so a key holding a large share of the rows is still split.
    `spread_by` must be deterministic (a row id or a hash of the row), and `drop` lists columns
    that are not needed afterwards.
    """
    kept = [c for c in df.columns if c not in drop]
    laid_out = (
        df.repartitionByRange(*order_by, *spread_by)
        .sortWithinPartitions(*order_by)
        .select(*kept, F.monotonically_increasing_id().alias("_slot"))
    )
    staged = staging.table(laid_out).withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    # One row per range partition.
    offsets = _offsets(sizes, "_part")
    return (
        staged.join(F.broadcast(offsets), F.col("_part") == F.col("_offset_of"))
        .select(*kept, (F.col("_offset") + place).alias(out))
    )


def rows_before(
    df: DataFrame, number: str, size: str, out: str, part_bits: int = 16
) -> DataFrame:
    """Sum of `size` over the rows with a smaller `number`, which tells rows apart, as `out`.

    Give a written table: it is read for the sums of the parts, 2**part_bits numbers each, and
    again for the rows.
    """
    parted = df.withColumn("_part", F.shiftright(number, part_bits))
    offsets = _offsets(parted.groupBy("_part").agg(F.sum(size).alias("_rows")), "_part")
    below = Window.partitionBy("_part").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.withColumn("_below", F.coalesce(F.sum(size).over(below), F.lit(0)))
        .join(F.broadcast(offsets), F.col("_part") == F.col("_offset_of"))
        .select(*df.columns, (F.col("_offset") + F.col("_below")).alias(out))
    )


def key_labels(
    df: DataFrame, order_by: Sequence[str], out: str, staging: Staging
) -> DataFrame:
    """Number the rows of a table that is expected, but not known, to be small.

    Measured first: a table within the broadcast bound is numbered by one window in one task,
    a larger one by `key_by_range`.
    """
    if not fits_broadcast(df):
        return key_by_range(df, order_by, out, staging)
    place = F.row_number().over(Window.orderBy(*order_by))
    return df.withColumn(out, place.cast("bigint"))
