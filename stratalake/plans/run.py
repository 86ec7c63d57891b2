"""All layers in one Spark application: raw -> bronze -> silver -> gold -> validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.context import RunContext
from stratalake.operators.checks import ConstraintViolation, require, warn
from stratalake.operators.colocate import co_distinct
from stratalake.plans.bronze import build_bronze
from stratalake.plans.gold import (
    CUSTOMER,
    build_dim_contract,
    build_dim_customer,
    build_dim_service,
    build_fact,
    co_locate_silver,
    label_rows,
)
from stratalake.plans.silver import build_silver
from stratalake.plans.validate import (
    NATURAL_KEY_CHECK,
    bronze_constraints,
    gold_constraints,
    gold_not_empty,
    silver_constraints,
)
from stratalake.schemas import GOLD_TABLES
from stratalake.sources.layers import LayerStore
from stratalake.sources.relational import RelationalStore
from stratalake.sources.staging import Staging

FACT_TABLE = "fact_customer_churn"
METRICS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    # Silver rows without a fact, and facts beyond one for each silver row.
    T.StructField("facts_lost", T.LongType()),
    T.StructField("facts_added", T.LongType()),
])

Store = LayerStore | RelationalStore


def load_bronze(
    raw: DataFrame, store: Store, ctx: RunContext, file_column: str | None = None
) -> list[tuple]:
    bronze = build_bronze(raw, ctx, copies="_copies", file_column=file_column)
    seen = store.write(
        bronze, "bronze", "subscribers", ctx.version,
        metrics={"read": F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint")},
    )
    removed = seen["read"] - seen["rows"]
    return [("bronze", "subscribers", seen["rows"], removed, None, None)]


def load_silver(
    store: Store, ctx: RunContext, bronze_version: str | None = None
) -> list[tuple]:
    """Silver of the given bronze version, by default the newest."""
    silver = build_silver(store.read("bronze", "subscribers", bronze_version), ctx)
    seen = store.write(silver, "silver", "subscribers", ctx.version)
    return [("silver", "subscribers", seen["rows"], None, None, None)]


def load_gold(
    store: Store, ctx: RunContext, silver_version: str | None = None
) -> list[tuple]:
    """Write the dimensions, then the fact built on them; publish the fact if gold holds up.

    Built on the given silver version, by default the newest. Readers take the newest version
    that all four tables have published, so they see this one only once it passed its checks;
    one that fails is taken back.
    """
    silver = store.read("silver", "subscribers", silver_version, row_id="_row_id")
    metrics: list[tuple] = []

    def publish(df: DataFrame, table: str) -> None:
        seen = store.write(df, "gold", table, ctx.version)
        metrics.append(("gold", table, seen["rows"], None, None, None))

    store.begin("gold", FACT_TABLE, ctx.version)
    with Staging(store.spark) as staging:
        rows, layout, people = silver, None, silver
        if ctx.customer_buckets:
            rows, layout = co_locate_silver(
                silver, ctx, staging, ctx.customer_buckets, row_id="_row_id"
            )
            people = co_distinct(rows, CUSTOMER)
        publish(build_dim_customer(people, ctx), "dim_customer")
        labels = staging.table(label_rows(silver))
        publish(build_dim_service(labels, staging), "dim_service")
        publish(build_dim_contract(labels, staging), "dim_contract")
        dims = {
            t: store.read("gold", t, ctx.version)
            for t in ("dim_customer", "dim_service", "dim_contract")
        }
        customers = layout.one(dims["dim_customer"]) if layout else None
        fact = build_fact(
            rows, dims, ctx, staging, row_id="_row_id", marked=True, customers=customers
        )
        seen = store.write(
            fact, "gold", FACT_TABLE, ctx.version, ctx.fact_partition_by,
            metrics={"matched": F.count_if("_first")}, publish=False,
        )
    try:
        require(gold_not_empty(dims | {FACT_TABLE: store.read("gold", FACT_TABLE, ctx.version)}))
    except ConstraintViolation:
        store.withdraw("gold", FACT_TABLE, ctx.version)
        raise
    store.publish("gold", FACT_TABLE, ctx.version)
    lost, added = silver.count() - seen["matched"], seen["rows"] - seen["matched"]
    return [*metrics, ("gold", FACT_TABLE, seen["rows"], None, lost, added)]


def validate_gold(store: Store) -> list:
    """All constraints of the newest gold, which is hidden again if one does not hold.

    Conflicting customer records are a property of the source: reported, not refused.
    """
    version = store.newest_shared("gold", GOLD_TABLES)
    try:
        return require(gold_constraints(store.gold()), warn_only=[NATURAL_KEY_CHECK])
    except ConstraintViolation:
        store.unpublish("gold", FACT_TABLE, version)
        raise


def run_layers(
    spark: SparkSession, raw: DataFrame, store: Store, ctx: RunContext,
    file_column: str | None = None,
) -> DataFrame:
    """Refresh every layer; one row of METRICS for each table.

    Every stage reads what this run wrote, also when later versions exist already. What bronze
    and silver declare about themselves is checked and only logged. Any failure propagates and
    leaves the previous gold in place.
    """
    metrics = load_bronze(raw, store, ctx, file_column)
    warn(bronze_constraints(store.read("bronze", "subscribers", ctx.version)))
    metrics += load_silver(store, ctx, ctx.version)
    warn(silver_constraints(store.read("silver", "subscribers", ctx.version)))
    metrics += load_gold(store, ctx, ctx.version)
    return spark.createDataFrame(metrics, METRICS)
