from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.functions import (
    base_name, bucketize, case_rules, flag_equals, map_values, normalize_text, pseudonymize,
    rounded_product, safe_ratio,
)
from stratalake.plans import gold as G


def column(spark, schema, values, expression):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_pseudonym_vectors(spark):
    got = column(spark, "id int", [0, 1, 2, None], pseudonymize(F.col("id")))
    assert got == ["5feceb66ffc86f38", "6b86b273ff34fce1", "d4735e3a265e16ee", None]


def test_pseudonym_salt_and_length(spark):
    plain, salted = (
        column(spark, "id int", [7], pseudonymize(F.col("id"), 64, salt))[0]
        for salt in (None, "s")
    )
    assert len(plain) == len(salted) == 64 and plain != salted
    assert column(spark, "id int", [None], pseudonymize(F.col("id"), 64, "s")) == [None]


def test_normalize_strips_spaces_only(spark):
    got = column(spark, "t string", ["  Yes ", "no\t", "", None], normalize_text(F.col("t")))
    assert got == ["yes", "no\t", "", None]


@pytest.mark.parametrize("total, months, expected", [
    ("20.02", 12, "1.67"), ("10.01", 2, "5.01"), ("10.00", 0, "0.00"), ("10.00", None, "0.00"),
    ("10.00", -3, "0.00"), (None, 3, None), (None, 0, "0.00"),
])
def test_safe_ratio(spark, total, months, expected):
    row = (total and Decimal(total), months)
    got = column(
        spark, "a decimal(10,2), b int", [row], safe_ratio(F.col("a"), F.col("b"))
    )
    assert got == [expected and Decimal(expected)]


def test_rounded_product(spark):
    rows = [(3, Decimal("0.10")), (None, Decimal("1.00")), (2, None)]
    got = column(
        spark, "a int, b decimal(10,2)", rows, rounded_product(F.col("a"), F.col("b"))
    )
    assert got == [Decimal("0.30"), None, None]


def test_tenure_bounds(spark):
    values = [-1, 0, 11, 12, 13, 24, 25, 48, 49, None]
    first, second, third, last = "0-12 months", "13-24 months", "25-48 months", "49+ months"
    assert column(spark, "t int", values, G.tenure_category(F.col("t"))) == [
        first, first, first, first, second, second, third, third, last, last,
    ]


def test_bands_must_ascend():
    with pytest.raises(ValueError, match="ascend"):
        bucketize(F.lit(1), [(5, "a"), (2, "b")], "c")


def test_bundle_matrix(spark):
    rows = [(i, s) for i in ("unknown", "no", "dsl", None) for s in ("yes", "no", None)]
    got = column(
        spark, "i string, s string", rows, G.service_bundle(F.col("i"), F.col("s"))
    )
    assert got == [
        "Basic", "Basic", "Basic", "Premium", "Standard", "Standard",
        "Premium", "Standard", "Standard", "Basic", "Basic", "Basic",
    ]


def test_contract_labels(spark):
    values = ["month-to-month", "one-year", "two-year", "one year", None]
    assert column(spark, "c string", values, G.contract_months(F.col("c"))) == [1, 12, 24, 0, 0]


def test_churn_flag_and_risk(spark):
    rows = [("yes", 5), ("no", 11), ("no", 12), ("unknown", None), (None, 3), ("Yes", 40)]
    churned = G.is_churned(F.col("c"))
    assert column(spark, "c string, t int", rows, churned) == [
        True, False, False, False, False, False,
    ]
    risk = column(spark, "c string, t int", rows, G.churn_risk(churned, F.col("t")))
    assert risk == [Decimal(x) for x in ("1.00", "0.70", "0.30", "0.30", "0.70", "0.30")]


def test_rules_without_rules_and_values(spark):
    assert column(spark, "x int", [1], case_rules([], "d")) == ["d"]
    assert column(spark, "x int", [1, 2, None], map_values(F.col("x"), {1: "a"}, "d")) == [
        "a", "d", "d",
    ]
    assert column(spark, "x string", ["a", None], flag_equals(F.col("x"), "a")) == [True, False]


def test_base_name(spark):
    got = column(spark, "p string", ["/a/b/c.csv", "c.csv", None], base_name(F.col("p")))
    assert got == ["c.csv", "c.csv", None]


def test_table_schemas_cover_limits():
    for (layer, table), schema in S.TABLES.items():
        limits = S.LIMITS[table if layer == "gold" else layer]
        assert set(limits) <= set(schema.names)


@pytest.mark.parametrize("value", [0.0, 5e-324, 2.2250738585072014e-308, 1.0, 1.5, 1e300, float("inf")])
def test_ranks_of_single_numbers(spark, value):
    from stratalake.functions import double_of_rank, double_to_rank

    for sign in (1.0, -1.0):
        rank = spark.range(1).select(double_to_rank(F.lit(sign * value))).first()[0]
        assert double_of_rank(rank) == sign * value
