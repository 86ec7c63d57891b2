from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stratalake import schemas as S
from stratalake.operators import checks as C

# Keys of the gold tables: (table, key columns, columns that may not be NULL).
_KEYS = [
    ("dim_customer", ["customer_sk"], ["customer_sk", "customer_id_anonymized"]),
    ("dim_service", ["service_sk"], ["service_sk"]),
    ("dim_contract", ["contract_sk"], ["contract_sk"]),
    ("fact_customer_churn", ["fact_sk"], ["fact_sk"]),
]
_FOREIGN_KEYS = [
    ("customer_sk", "dim_customer"), ("service_sk", "dim_service"), ("contract_sk", "dim_contract"),
]
NATURAL_KEY_CHECK = "unique(customer_id_anonymized)"


def gold_not_empty(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The checks a run must pass: every gold table has rows."""
    return C.union_reports([C.check_not_empty(gold[t], t) for t in S.GOLD_TABLES])


def gold_constraints(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared key, reference and size limit of the gold tables, as one report."""
    reports = [gold_not_empty(gold)]
    for table, key, required in _KEYS:
        reports.append(C.check_unique(gold[table], table, key))
        reports.append(C.check_columns(gold[table], table, required, S.LIMITS[table]))
    reports.append(
        C.check_unique(gold["dim_customer"], "dim_customer", ["customer_id_anonymized"])
    )
    for sk, dim in _FOREIGN_KEYS:
        reports.append(C.check_foreign_key(
            gold["fact_customer_churn"], "fact_customer_churn", sk, gold[dim], sk
        ))
    return C.union_reports(reports)


def silver_constraints(silver: DataFrame) -> DataFrame:
    """Silver's declared key and size limits."""
    key = ["customer_id_anonymized"]
    return C.union_reports([
        C.check_unique(silver, "silver", key),
        C.check_columns(silver, "silver", key, S.LIMITS["silver"]),
    ])


def bronze_constraints(bronze: DataFrame) -> DataFrame:
    """Bronze's size limits; it declares no key."""
    limits = {c: limit for c, limit in S.LIMITS["bronze"].items() if c in bronze.columns}
    return C.check_domain(bronze, "bronze", limits)
