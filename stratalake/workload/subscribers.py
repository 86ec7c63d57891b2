"""Dirty subscriber records derived from the customer and orders tables.

NULLs in every column kind, padded and mixed-case text, exact duplicates, zero and missing
tenure, and every label the gold rules know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import case_rules
from stratalake.schemas import MONEY, RAW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subscriber_raw(
    spark: SparkSession, sf_dir: str, corrected: bool = False, missing_ids: bool = False
) -> DataFrame:
    """The raw records. With `corrected`, a second delivery states a known age one year higher;
    with `missing_ids`, every tenth customer has no id."""
    spend = (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"))
    )
    base = table(spark, sf_dir, "customer").join(spend, "c_custkey")
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    none = F.lit(None)
    rows = base.select(
        key.cast("int").alias("CustomerID"),
        F.when(key % 17 != 0, (18 + (key * 7) % 63).cast("int")).alias("Age"),
        case_rules([(key % 23 == 0, none), (key % 2 == 0, " Male")], "FEMALE ").alias("Gender"),
        case_rules(
            [(key % 29 == 0, none), (key % 19 == 0, F.lit(0))], (F.col("n") * 3).cast("int")
        ).cast("int").alias("Tenure"),
        F.abs("c_acctbal").cast(MONEY).alias("MonthlyCharges"),
        case_rules([
            (segment == "BUILDING", "Month-to-Month"), (segment == "AUTOMOBILE", " One-Year"),
            (segment == "MACHINERY", "TWO-YEAR "), (segment == "HOUSEHOLD", "month-to-month"),
        ], none).alias("ContractType"),
        case_rules([
            (nation % 4 == 0, "DSL"), (nation % 4 == 1, "Fiber Optic"), (nation % 4 == 3, "dsl "),
        ], none).alias("InternetService"),
        F.when(key % 37 != 0, F.col("total").cast(MONEY)).alias("TotalCharges"),
        case_rules([(nation % 3 == 0, "Yes"), (nation % 3 == 1, "No")], none).alias("TechSupport"),
        case_rules([
            (key % 31 == 0, none), (key % 5 == 0, "Yes"), (key % 5 == 1, " YES "),
        ], "No").alias("Churn"),
    )
    # Every eleventh record was delivered twice.
    deliveries = F.when(F.col("CustomerID") % 11 == 0, 2).otherwise(1)
    delivered = rows.withColumn("_delivery", F.explode(F.sequence(F.lit(1), deliveries)))
    if corrected:
        delivered = delivered.withColumn("Age", F.col("Age") + F.col("_delivery") - 1)
    if missing_ids:
        delivered = delivered.withColumn("CustomerID", F.when(F.col("CustomerID") % 10 != 0, F.col("CustomerID")))
    return delivered.select(*RAW.names)
