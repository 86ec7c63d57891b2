from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.report import rate_report

# The report as SQL text over tables registered as gold.* (see LayerStore.register).
CHURN_RATE_SQL = """
    SELECT contract_type, internet_service, count(customer_sk) AS customer_count,
           count_if(is_churned) / double(count(*)) * 100 AS churn_rate_percent
    FROM {fact} JOIN {contract} USING (contract_sk) JOIN {service} USING (service_sk)
    GROUP BY contract_type, internet_service
    ORDER BY churn_rate_percent DESC, contract_type, internet_service
"""


def churn_rate_report(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Customers and percentage churned per contract type and internet service."""
    return rate_report(
        gold["fact_customer_churn"],
        {"contract_sk": gold["dim_contract"], "service_sk": gold["dim_service"]},
        group_by=["contract_type", "internet_service"], flag="is_churned",
        counted="customer_sk", count_as="customer_count", rate_as="churn_rate_percent",
    )


def churn_rate_report_sql(spark: SparkSession, gold: Mapping[str, DataFrame]) -> DataFrame:
    """The same report as SQL over the given frames."""
    return spark.sql(
        CHURN_RATE_SQL, fact=gold["fact_customer_churn"], contract=gold["dim_contract"],
        service=gold["dim_service"],
    )
