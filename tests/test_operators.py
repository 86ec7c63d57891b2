from __future__ import annotations

import statistics
from decimal import Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import double_to_rank, rank_to_double
from stratalake.operators.columns import (
    conform, fallback_column, lowercase_names, normalize_columns, rename_variants,
    select_available,
)
from stratalake.operators.dedupe import dedupe_exact, duplicates_removed
from stratalake.operators.impute import constant_impute, median_impute, na_tokens
from stratalake.operators.medians import column_medians
from stratalake.operators.quality import completeness_score


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lowercase_names(spark):
    assert lowercase_names(spark.createDataFrame([(1, 2)], "A int, bC int")).columns == ["a", "bc"]
    with pytest.raises(ValueError, match="case"):
        lowercase_names(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A"))


def test_rename_variants(spark):
    both = spark.createDataFrame(
        [(1, "a", None), (2, None, "b"), (3, "c", "d")],
        "id int, contract string, contracttype string",
    )
    variants = {"contract_type": ["contract", "contracttype"], "other": ["absent"]}
    named = rename_variants(both, variants)
    assert named.columns == ["id", "contract_type"]
    assert rows(named) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError, match="contract_type"):
        rename_variants(both, variants, on_collision="error")
    with pytest.raises(ValueError, match="on_collision"):
        rename_variants(both, variants, on_collision="whatever")
    single = rename_variants(both.drop("contract"), variants, on_collision="error")
    assert rows(single) == [(1, None), (2, "b"), (3, "d")]


def test_fallback_column(spark):
    df = spark.createDataFrame([(1, 0)], "id int, SeniorCitizen int")
    assert fallback_column(df, "age", ["seniorcitizen"], T.IntegerType()).columns == ["id", "age"]
    absent = fallback_column(df.select("id"), "age", ["seniorcitizen"], T.IntegerType())
    assert absent.schema["age"].dataType == T.IntegerType() and rows(absent) == [(1, None)]
    assert fallback_column(df, "id", ["seniorcitizen"], T.IntegerType()) is df


def test_select_normalize_conform(spark):
    df = spark.createDataFrame([(" A ", 1)], "b string, a int")
    assert select_available(df, ["a", "x", "b"]).columns == ["a", "b"]
    assert rows(normalize_columns(df, ["b", "absent"])) == [("a", 1)]
    target = T.StructType([T.StructField("a", T.LongType())])
    assert conform(df, target).schema["a"].dataType == T.LongType()


def test_dedupe_counts_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, None)], "a int, b string")
    assert rows(dedupe_exact(df)) == [(1, "x"), (1, None), (2, None)]
    assert rows(dedupe_exact(df, copies="n")) == [(1, "x", 1), (1, None, 2), (2, None, 1)]
    assert rows(duplicates_removed(df)) == [(4, 3, 1)]
    assert rows(duplicates_removed(df.limit(0))) == [(0, 0, 0)]


def test_dedupe_keeps_smallest_of_uncompared_columns(spark):
    df = spark.createDataFrame([(1, "f2"), (1, "f1"), (2, "f3")], "a int, file string")
    assert rows(dedupe_exact(df, keep_min=["file"])) == [(1, "f1"), (2, "f3")]


def test_na_tokens(spark):
    words = ["", "NA", "N/A", "None", " ", "5", None, "nan", "Na"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = [r[0] for r in na_tokens(df).collect()]
    assert got == [None, None, None, None, " ", "5", None, None, "Na"]


def test_median_impute_rounds_half_up_and_keeps_types(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.00"), None, "x"), (2, Decimal("1.01"), None, None), (None, None, None, "y")],
        "i int, m decimal(10,2), e int, t string",
    )
    filled = median_impute(df)
    assert filled.schema == df.schema or [f.dataType for f in filled.schema] == [
        f.dataType for f in df.schema
    ]
    assert (2, Decimal("1.01"), None, "y") in map(tuple, filled.collect())
    assert (None, Decimal("1.01"), None, "y") in map(
        tuple, median_impute(df, exclude=["I"]).collect()
    )
    assert rows(constant_impute(df.select("t"))) == [("Unknown",), ("x",), ("y",)]


def test_median_impute_approx(spark):
    df = spark.range(1001).select(F.when(F.col("id") != 500, F.col("id")).cast("int").alias("i"))
    assert median_impute(df, approx=True).where("i is null").count() == 0


def test_median_of_negative_and_wide_columns(spark):
    df = spark.range(-1000, 3000).select(
        F.col("id").cast("int").alias("small"), (F.col("id") * 10**15).alias("wide"),
        F.when(F.col("id") % 3 == 0, (F.col("id") / 7).cast("decimal(18,4)")).alias("dec"),
    )
    got = dict(map(tuple, column_medians(df, df.columns).collect()))
    exact = df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    assert got == pytest.approx({k: float(v) for k, v in exact.items()})


@pytest.mark.parametrize("dtype, low, high, middle", [
    ("decimal(18,18)", "0.000000000000000001", "0.000000000000000004", "0.000000000000000003"),
    ("decimal(18,0)", "999999999999999998", "999999999999999999", "999999999999999999"),
    ("decimal(10,2)", "-1.01", "-1.00", "-1.01"), ("bigint", "9223372036854775806",
     "9223372036854775807", "9223372036854775807"), ("tinyint", "1", "2", "2"),
])
def test_median_fill_is_exact_in_the_column_type(spark, dtype, low, high, middle):
    df = spark.sql(
        f"select id, cast(v as {dtype}) v from values (1, '{low}'), (2, '{high}'), (3, null) t(id, v)"
    )
    filled = median_impute(df, exclude=["id"])
    assert filled.schema["v"].dataType == df.schema["v"].dataType
    expected = spark.sql(f"select cast('{middle}' as {dtype})").first()[0]
    assert filled.where("id = 3").first()["v"] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=20, max_size=60))
def test_double_ranks_keep_order_and_value(spark, values):
    edges = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.0, 2.0, 1.9999999999999998,
             1.7976931348623157e308, float("inf"), float("-inf"), 8.0, 0.5, 1e15 + 0.125]
    df = spark.createDataFrame([(v,) for v in values + edges], "v double")
    ranked = df.select("v", double_to_rank(F.col("v")).alias("r")).withColumn(
        "back", rank_to_double(F.col("r"))
    ).collect()
    assert all(row["v"] == row["back"] for row in ranked)
    by_rank = sorted(ranked, key=lambda row: row["r"])
    assert [row["v"] for row in by_rank] == sorted(row["v"] for row in ranked)


def test_double_rank_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(double_to_rank(F.col("v"))).collect()] == [None, None]


def test_median_of_doubles_and_floats(spark):
    df = spark.range(-500, 1500).select(
        F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("d"),
        (F.col("id") * 1.5).cast("float").alias("f"), F.col("id").cast("int").alias("i"),
    )
    got = dict(map(tuple, column_medians(df, df.columns).collect()))
    assert got == df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    filled = median_impute(df)
    assert [f.dataType for f in filled.schema] == [f.dataType for f in df.schema]
    assert filled.where(F.col("d") == got["d"]).count() >= df.where("d is null").count() > 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 4.0), (3, float("nan")), (4, None)], "id int, v double")
    assert [r["v"] for r in median_impute(df).orderBy("id").collect()] == [1.0, 4.0, 2.5, 2.5]


WIDE = [sign * value for sign in (1, -1) for value in (
    0, 1, 7, 10**3 - 1, 10**3, 10**10, 10**17 + 5, 10**24 - 1, 10**24, 10**31, 10**38 - 1, 10**37 + 3,
)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(WIDE), min_size=1, max_size=9), st.sampled_from([0, 4, 20]))
def test_middle_values_of_wide_decimals(spark, values, scale):
    from stratalake.operators.medians import middle_units

    with localcontext() as exact:
        exact.prec = 40
        shown = [str(Decimal(v).scaleb(-scale)) for v in values]
    df = spark.createDataFrame([(v,) for v in shown], "t string").selectExpr(
        f"cast(t as decimal(38,{scale})) v"
    )
    got = middle_units(df, ["v"]).select("lower", "upper").first()
    ordered, n = sorted(values), len(values)
    assert tuple(map(int, got)) == (ordered[(n - 1) // 2], ordered[n // 2])


def test_wide_decimals_of_any_digits_take_few_passes(spark, monkeypatch):
    """Values that differ in their first, last or twentieth digits, columns of two scales."""
    from stratalake.operators import medians as M

    passes = []
    counted = M._wide_histogram
    monkeypatch.setattr(M, "_wide_histogram", lambda *args: passes.append(1) or counted(*args))
    df = spark.range(3001).selectExpr(
        "cast(concat('9', lpad(id, 33, '0')) as decimal(38,4)) last",
        "cast(concat(1000 + id, repeat('0', 30)) as decimal(38,4)) first",
        "cast(concat('-0.', repeat('3', 16), lpad(id, 4, '0')) as decimal(38,20)) fraction",
        "cast(if(id % 2 = 0, id, null) as decimal(38,4)) half",
        "cast(7 as decimal(30,4)) same", "cast(null as decimal(38,4)) none",
    )
    got = {r["column_name"]: (int(r["lower"]), int(r["upper"])) for r in M.middle_units(df, df.columns).collect()}
    assert got == {
        "last": (int("9" + "1500".zfill(33)) * 10**4,) * 2, "first": (2500 * 10**34,) * 2,
        "fraction": (-int("3" * 16 + "1500"),) * 2, "half": (1500 * 10**4,) * 2, "same": (70000,) * 2,
    }
    # Two scales, at most three passes each.
    assert len(passes) <= 6
    passes.clear()
    assert [r[0] for r in M.middle_units(df, ["half", "last"], only_incomplete=True).collect()] == ["half"]


def test_wide_decimals_are_filled_exactly(spark):
    df = spark.sql("""
        select id, cast(v as decimal(38,2)) v, cast(w as decimal(38,0)) w from values
          (1, '-9999999999999999999999999999999999.98', '999999999999999999999999999999999997'),
          (2, '-9999999999999999999999999999999999.95', '999999999999999999999999999999999998'),
          (3, null, null) t(id, v, w)""")
    row = median_impute(df, exclude=["id"]).where("id = 3").first()
    assert str(row["v"]) == "-9999999999999999999999999999999999.97"
    assert int(row["w"]) == 999999999999999999999999999999999998


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)), min_size=1, max_size=60))
def test_median_matches_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(4)
    known = [v for v in values if v is not None]
    got = [r["median"] for r in column_medians(df, ["v"]).collect()]
    assert got == ([float(statistics.median(known))] if known else [])


EDGES = [sign * (1 << bits) + step for bits in (18, 20, 21, 38, 42, 62) for sign in (1, -1)
         for step in (-1, 0, 1)] + [-(2**63), 2**63 - 1, 0]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(EDGES), min_size=1, max_size=9))
def test_middle_values_at_bucket_edges(spark, values):
    from stratalake.operators.medians import middle_units

    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = middle_units(df, ["v"]).select("lower", "upper").first()
    ordered, n = sorted(values), len(values)
    assert tuple(got) == (ordered[(n - 1) // 2], ordered[n // 2])


def test_buckets_ascend_and_refine(spark):
    from stratalake.operators.medians import _bucket

    df = spark.createDataFrame([(v,) for v in EDGES], "v bigint").select(
        "v", *[_bucket(F.col("v"), level).alias(f"b{level}") for level in range(3)]
    )
    ranked = sorted(map(tuple, df.collect()))
    for level in (1, 2):
        starts = [row[level] for row in ranked]
        assert starts == sorted(starts)
    assert all(row[3] == row[0] for row in ranked)


def test_everyday_amounts_need_one_pass(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 90).cast("int").alias("age"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 4 + 0.25).cast("decimal(10,2)").alias("total"),
        F.col("id").cast("int").alias("key"),
    ).repartition(4)
    filled = median_impute(df)
    filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString()
    ran = plan.split("== Initial Plan ==")[0]
    # Only the passes after the first look up a value's place.
    assert "place" in plan and "place" not in ran


def test_median_with_one_value_in_a_third_of_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("v")
    )
    got = column_medians(df, ["v"]).first()["median"]
    assert got == df.agg(F.median("v")).first()[0]


def test_completeness_score(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None)], "a int, b int, c string")
    assert [r[0] for r in completeness_score(df).select("data_quality_score").collect()] == [
        Decimal("0.67"), Decimal("0.00"),
    ]
    two = completeness_score(df, ["a", "c"]).select("data_quality_score").first()[0]
    assert two == Decimal("1.00")
