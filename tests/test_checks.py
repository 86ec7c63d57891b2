from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.operators import checks as C
from stratalake.plans.validate import gold_constraints, gold_not_empty


def result(report):
    return {(r["table"], r["check"]): r["violations"] for r in report.collect()}


@pytest.fixture
def broken_gold(spark):
    """Duplicate key, orphan reference, missing natural key, over-long text, empty table."""
    def frame(table, rows):
        schema = S.TABLES[("gold", table)]
        filled = [[row.get(f.name) for f in schema] for row in rows]
        return spark.createDataFrame(filled, schema)

    return {
        "dim_customer": frame("dim_customer", [
            {"customer_sk": 1, "customer_id_anonymized": "a", "gender": "x" * 21},
            {"customer_sk": 1, "customer_id_anonymized": "b"},
            {"customer_sk": 2},
        ]),
        "dim_service": frame("dim_service", [{"service_sk": 1}]),
        "dim_contract": frame("dim_contract", []),
        "fact_customer_churn": frame("fact_customer_churn", [
            {"fact_sk": 1, "customer_sk": 1, "service_sk": 1, "contract_sk": 9},
            {"fact_sk": 2, "customer_sk": 7, "service_sk": 1},
            {"fact_sk": 3, "customer_sk": 7, "service_sk": None},
        ]),
    }


def test_broken_gold(broken_gold):
    found = {k: n for k, n in result(gold_constraints(broken_gold)).items() if n}
    assert found == {
        ("dim_contract", "not_empty"): 1,
        ("dim_customer", "unique(customer_sk)"): 1,
        ("dim_customer", "not_null(customer_id_anonymized)"): 1,
        ("dim_customer", "domain(gender text(20))"): 1,
        ("fact_customer_churn", "foreign_key(customer_sk)"): 2,
        ("fact_customer_churn", "foreign_key(contract_sk)"): 1,
    }


def test_require(broken_gold):
    with pytest.raises(C.ConstraintViolation, match="dim_contract: not_empty has 1"):
        C.require(gold_not_empty(broken_gold))
    assert len(C.require(gold_not_empty(broken_gold), warn_only=["not_empty"])) == 4


def test_domain_of_numbers(spark):
    df = spark.createDataFrame([(1.5,), (999.994,), (1000.0,), (None,)], "x double")
    assert result(C.check_domain(df, "t", {"x": (5, 2)})) == {("t", "domain(x numeric(5,2))"): 1}


def test_unique_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert result(C.check_unique(df, "t", ["k"])) == {("t", "unique(k)"): 2}


def test_row_counts(spark):
    counts = C.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("a", 3), ("b", 0)]


def test_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("t")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = C.check_not_null(df, "t", ["id", "t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_no_checks_is_a_mistake(spark):
    with pytest.raises(ValueError, match="no checks"):
        C.check_not_null(spark.range(1), "t", [])
