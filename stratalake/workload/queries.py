"""One query per operator or layer, over the given tables.

Money and scores are shown as doubles and times as epoch seconds, so that results compare across
engines; everything else keeps its type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas as S
from stratalake.context import RunContext
from stratalake.functions import case_rules, normalize_text, pseudonymize, rounded_product, safe_ratio
from stratalake.operators import checks as C
from stratalake.operators.colocate import check_co_located_key, co_distinct, co_locate
from stratalake.operators.columns import (
    fallback_column,
    lowercase_names,
    normalize_columns,
    numeric_columns,
    rename_variants,
    select_available,
)
from stratalake.operators.dedupe import dedupe_exact, duplicates_removed
from stratalake.operators.impute import constant_impute, median_impute
from stratalake.operators.keys import key_by_hex_prefix, key_by_range
from stratalake.operators.ledger import RowLedger
from stratalake.operators.medians import column_medians
from stratalake.operators.quality import completeness_score
from stratalake.operators.rank_state import RankState
from stratalake.operators.registry import KeyRegistry
from stratalake.plans import gold as G
from stratalake.plans.bronze import build_bronze
from stratalake.plans.history import next_history, one_per_customer
from stratalake.plans.report import churn_rate_report, churn_rate_report_sql
from stratalake.plans.run import run_layers
from stratalake.plans.silver import build_silver
from stratalake.plans.validate import bronze_constraints, gold_constraints, silver_constraints
from stratalake.sources.csv import read_csv_raw
from stratalake.sources.layers import LayerStore
from stratalake.sources.staging import Staging
from stratalake.streaming.refresh import refresh_silver
from stratalake.workload.subscribers import subscriber_raw, table

# 2024-01-01 00:00:00 UTC
RUN = RunContext(
    run_id="run-1", run_ts=datetime(2024, 1, 1, tzinfo=timezone.utc),
    source_file="/landing/2024/subscribers.csv",
)

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_timestamp(column).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema])


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw records under lower-case names, as most operators are shown on."""
    return lowercase_names(subscriber_raw(spark, d))


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return build_bronze(subscriber_raw(spark, d), RUN)


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return build_silver(_bronze(spark, d), RUN)


def _gold(
    silver: DataFrame, staging: Staging, ctx: RunContext = RUN
) -> dict[str, DataFrame]:
    """Gold frames over a written silver table."""
    labels = staging.table(G.label_rows(silver))
    gold = {
        "dim_customer": staging.table(G.build_dim_customer(silver, ctx)),
        "dim_service": staging.table(G.build_dim_service(labels, staging)),
        "dim_contract": staging.table(G.build_dim_contract(labels, staging)),
    }
    return gold | {"fact_customer_churn": G.build_fact(silver, gold, ctx, staging)}


def _standard_gold(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    staging = Staging(spark)
    return _gold(staging.table(_silver(spark, d)), staging)


# --- sources -----------------------------------------------------------------------------------

def _csv_folder(spark: SparkSession, d: str) -> str:
    """The raw records as CSV, with a different missing-value word from row to row."""
    raw = subscriber_raw(spark, d)
    word = F.element_at(
        F.array(*map(F.lit, ["", "NA", "N/A", "None", "null", "NaN", "n/a"])),
        (F.col("CustomerID") % 7 + 1).cast("int"),
    )
    texts = raw.select(*[F.coalesce(F.col(c).cast("string"), word).alias(c) for c in raw.columns])
    path = Staging(spark).folder()
    texts.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def q_subscriber_raw(spark, d):
    return comparable(_raw(spark, d))


def q_csv_na_scan(spark, d):
    return comparable(lowercase_names(read_csv_raw(spark, _csv_folder(spark, d))))


def q_csv_inferred_scan(spark, d):
    return comparable(lowercase_names(read_csv_raw(spark, _csv_folder(spark, d), types="infer")))


def _text_csv(rows: DataFrame, header: str, staging: Staging) -> str:
    """Lines of `rows` (one text column) as CSV, as they are, below one header per file."""
    path = staging.folder()
    rows.select(F.col(rows.columns[0]).alias(header)).write.options(
        header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).option("sep", "\u0001").csv(path)
    return path


def q_csv_long_rows(spark, d):
    """Every tenth customer's row has a field too many, every seventh's one too few."""
    key = F.col("c_custkey")
    line = case_rules([
        (key % 10 == 0, F.concat_ws(",", key, F.lit('"a,""b"""'), F.lit("c"), F.lit("extra"))),
        (key % 7 == 0, F.concat_ws(",", key, F.lit("short"))),
    ], F.concat_ws(",", key, F.lit('"x,y"'), "c_mktsegment"))
    path = _text_csv(table(spark, d, "customer").select(line.alias("line")), "id,note,segment", Staging(spark))
    rows = read_csv_raw(spark, path, types={"id": T.LongType()}, on_bad="null")
    long_rows = rows.agg(F.count(S.LONG_ROW_COLUMN)).scalar().alias("long_rows")
    return rows.select("id", "note", "segment", S.LONG_ROW_COLUMN, long_rows)


def q_csv_inferred_decimals(spark, d):
    """Numbers with as many decimals as they need: none is rounded to fit a narrower type."""
    key = F.col("c_custkey")
    line = F.concat_ws(
        ",", key, F.concat(key, F.lit(".000")), F.concat(key, F.lit(".50")),
        F.concat(F.lit("1."), F.lpad(key.cast("string"), 12, "0")),
        F.concat(key % 5 + 1, F.lit(".00000000000")),
    )
    path = _text_csv(table(spark, d, "customer").select(line.alias("line")), "id,whole,half,fine,zeros", Staging(spark))
    return comparable(read_csv_raw(spark, path, types="infer"))


def q_csv_exponent_numbers(spark, d):
    """Numbers with exponents: whole ones, ones with a decimal, and ones with too many for money."""
    key = F.col("c_custkey").cast("string")
    line = F.concat_ws(
        ",", key, F.concat(key, F.lit(".5e1")), F.concat(key, F.lit("E-1")), F.concat(key, F.lit("00e-2")),
        F.concat(key, F.lit("e-3")),
    )
    path = _text_csv(table(spark, d, "customer").select(line.alias("line")), "id,tens,tenths,ones,fine", Staging(spark))
    return comparable(read_csv_raw(spark, path, types="infer"))


# --- bronze ------------------------------------------------------------------------------------

def q_dedupe_exact(spark, d):
    return comparable(dedupe_exact(_raw(spark, d)))


def q_dedupe_removed(spark, d):
    return duplicates_removed(_raw(spark, d))


def q_dedupe_lineitem(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey")
    return dedupe_exact(lines, copies="copies")


def q_column_medians(spark, d):
    distinct = dedupe_exact(_raw(spark, d))
    return column_medians(distinct, numeric_columns(distinct))


def q_lineitem_medians(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        *[F.col(c).cast(S.MONEY).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount")],
    )
    return column_medians(lines, lines.columns)


def q_double_medians(spark, d):
    def medians(name: str, *columns: str) -> DataFrame:
        return column_medians(table(spark, d, name), columns)

    return (
        medians("lineitem", "l_extendedprice", "l_tax").unionByName(medians("events", "value"))
        .unionByName(medians("customer", "c_acctbal"))
    )


def q_wide_decimal_medians(spark, d):
    """Decimals of 38 digits that differ in their first, middle and last ones."""
    lines = table(spark, d, "lineitem")
    wide, key = T.DecimalType(38, 4), F.col("l_orderkey").cast("decimal(20,0)")
    return column_medians(lines.select(
        (key * F.lit(10**14).cast("decimal(15,0)") + F.col("l_linenumber")).cast(wide).alias("high"),
        (F.lit(10**14).cast("decimal(15,0)") * F.lit(10**14).cast("decimal(15,0)")
         - F.col("l_extendedprice").cast("decimal(10,2)")).cast(wide).alias("low"),
        F.when(F.col("l_linenumber") > 1, -key / 8).cast(wide).alias("negative"),
    ), ["high", "low", "negative"])


def q_impute_median(spark, d):
    columns = ["customerid", "age", "tenure", "monthlycharges", "totalcharges"]
    return comparable(median_impute(dedupe_exact(_raw(spark, d))).select(*columns))


def q_impute_unknown(spark, d):
    columns = [
        "customerid", "gender", "contracttype", "internetservice", "techsupport", "churn",
    ]
    return constant_impute(dedupe_exact(_raw(spark, d)).select(*columns))


def q_bronze(spark, d):
    return comparable(_bronze(spark, d))


# --- silver ------------------------------------------------------------------------------------

def q_rename_variants(spark, d):
    return comparable(rename_variants(_raw(spark, d), S.SILVER_VARIANTS))


def q_rename_collision(spark, d):
    """Both spellings of the contract column present, each with gaps of its own."""
    both = _raw(spark, d).select(
        "customerid", F.when(F.col("churn") == "No", F.col("contracttype")).alias("contract"),
        "contracttype",
    )
    return rename_variants(both, {"contract_type": S.SILVER_VARIANTS["contract_type"]})


def q_age_fallback(spark, d):
    senior = _raw(spark, d).withColumnRenamed("age", "seniorcitizen")
    return fallback_column(senior, "age", ["seniorcitizen"], T.IntegerType()).select(
        "customerid", "age"
    )


def q_age_absent(spark, d):
    bare = _raw(spark, d).drop("age")
    filled = fallback_column(bare, "age", ["seniorcitizen"], T.IntegerType())
    return filled.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("age").alias("known_ages")
    )


def q_select_available(spark, d):
    wanted = ["churn", "nosuchcolumn", "customerid", "tenure"]
    return select_available(_raw(spark, d), wanted)


def q_pseudonymize(spark, d):
    customers = table(spark, d, "customer")
    return customers.select("c_custkey", pseudonymize(F.col("c_custkey")).alias("pseudonym"))


def q_pseudonymize_salted(spark, d):
    customers = table(spark, d, "customer")
    return customers.select(
        "c_custkey", pseudonymize(F.col("c_custkey"), length=64, salt="pepper").alias("pseudonym")
    )


def q_normalize_text(spark, d):
    raw = _raw(spark, d)
    columns = ["gender", "contracttype", "internetservice", "techsupport", "churn", "absent"]
    return normalize_columns(raw, columns).select("customerid", *columns[:-1])


def q_normalize_documents(spark, d):
    documents = table(spark, d, "documents")
    return documents.select("doc_id", F.md5(normalize_text(F.col("text"))).alias("text_md5"))


def q_avg_monthly_spend(spark, d):
    spend = safe_ratio(F.col("totalcharges"), F.col("tenure")).alias("avg_monthly_spend")
    return comparable(_raw(spark, d).select("customerid", "totalcharges", "tenure", spend))


def q_data_quality_score(spark, d):
    return comparable(completeness_score(_raw(spark, d)).select("customerid", "data_quality_score"))


def q_silver(spark, d):
    return comparable(_silver(spark, d))


def q_silver_drifted(spark, d):
    """An extract with a contract column under its short name and a senior flag for the age."""
    drifted = _raw(spark, d).withColumnsRenamed(
        {"contracttype": "contract", "age": "seniorcitizen"}
    )
    return comparable(build_silver(drifted, RUN))


def q_silver_streamed(spark, d):
    staging = Staging(spark)
    bronze, silver = staging.folder(), staging.folder()
    _bronze(spark, d).write.parquet(bronze)
    refresh_silver(spark, bronze, silver, staging.folder(), RUN)
    return comparable(spark.read.schema(S.SILVER).parquet(silver))


def q_silver_streamed_drifted(spark, d):
    """The same drifted extract through the streamed refresh."""
    staging = Staging(spark)
    bronze, silver = staging.folder(), staging.folder()
    _raw(spark, d).withColumnsRenamed(
        {"contracttype": "contract", "age": "seniorcitizen"}
    ).write.parquet(bronze)
    refresh_silver(spark, bronze, silver, staging.folder(), RUN)
    return comparable(spark.read.schema(S.SILVER).parquet(silver))


# --- gold rules --------------------------------------------------------------------------------

def _clean(spark, d):
    """Raw records under silver names with normalised text; gaps are kept."""
    named = rename_variants(_raw(spark, d), S.SILVER_VARIANTS)
    return normalize_columns(named, S.SILVER_TEXT_COLUMNS)


def q_tenure_category(spark, d):
    category = G.tenure_category(F.col("tenure")).alias("tenure_category")
    return _clean(spark, d).select("customerid", "tenure", category)


def q_service_bundle(spark, d):
    bundle = G.service_bundle(F.col("internet_service"), F.col("tech_support"))
    return _clean(spark, d).select(
        "customerid", "internet_service", "tech_support", bundle.alias("service_bundle_type")
    )


def q_contract_months(spark, d):
    months = G.contract_months(F.col("contract_type")).alias("contract_duration_months")
    return _clean(spark, d).select("customerid", "contract_type", months)


def q_total_revenue(spark, d):
    revenue = rounded_product(F.col("tenure"), F.col("monthly_charges")).alias("total_revenue")
    return comparable(_clean(spark, d).select("customerid", revenue))


def q_is_churned(spark, d):
    return _clean(spark, d).select("customerid", G.is_churned(F.col("churn")).alias("is_churned"))


def q_churn_risk(spark, d):
    risk = G.churn_risk(G.is_churned(F.col("churn")), F.col("tenure")).alias("churn_risk_score")
    return comparable(_clean(spark, d).select("customerid", risk))


# --- gold tables -------------------------------------------------------------------------------

def q_dim_customer(spark, d):
    silver = Staging(spark).table(_silver(spark, d))
    return comparable(G.build_dim_customer(silver, RUN))


def q_dim_service(spark, d):
    staging = Staging(spark)
    return G.build_dim_service(staging.table(G.label_rows(_silver(spark, d))), staging)


def q_dim_contract(spark, d):
    staging = Staging(spark)
    return G.build_dim_contract(staging.table(G.label_rows(_silver(spark, d))), staging)


def q_dense_key_distinct(spark, d):
    pairs = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return key_by_range(pairs, ["l_partkey", "l_suppkey"], "pair_sk", Staging(spark))


def q_dense_key_digest(spark, d):
    orders = table(spark, d, "orders").select(
        pseudonymize(F.col("o_orderkey")).alias("order_digest"), "o_orderkey"
    )
    return key_by_hex_prefix(orders, ["order_digest", "o_orderkey"], "order_sk")


LINE_ORDER = [
    "l_returnflag", "l_linestatus", "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
]


def q_dense_key_rows(spark, d):
    """Every line item numbered, led by a column with three values."""
    lines = table(spark, d, "lineitem").select(*LINE_ORDER)
    keyed = key_by_range(lines, LINE_ORDER, "line_sk", Staging(spark))
    return keyed.select("line_sk", "l_returnflag", "l_suppkey", "l_orderkey", "l_linenumber")


def q_fact_churn(spark, d):
    return comparable(_standard_gold(spark, d)["fact_customer_churn"])


def q_fact_colocated(spark, d):
    """Facts whose customers come from matching buckets of silver and the dimension."""
    staging = Staging(spark)
    silver = staging.table(_silver(spark, d))
    labels = staging.table(G.label_rows(silver))
    rows, layout = G.co_locate_silver(silver, RUN, staging, buckets=8)
    customers = layout.one(G.build_dim_customer(co_distinct(rows, G.CUSTOMER), RUN))
    dims = {
        "dim_service": staging.table(G.build_dim_service(labels, staging)),
        "dim_contract": staging.table(G.build_dim_contract(labels, staging)),
    }
    return comparable(G.build_fact(rows, dims, RUN, staging, customers=customers))


def q_fact_nullsafe_lookup(spark, d):
    """Records with gaps left open: NULL labels still find their dimension rows."""
    staging, ctx = Staging(spark), replace(RUN, null_safe_lookup=True)
    silver = staging.table(build_silver(dedupe_exact(_raw(spark, d)), ctx))
    return comparable(_gold(silver, staging, ctx)["fact_customer_churn"])


def q_fact_null_keys_dropped(spark, d):
    """The same records under plain equality: facts with a NULL label drop out."""
    staging = Staging(spark)
    silver = staging.table(build_silver(dedupe_exact(_raw(spark, d)), RUN))
    return comparable(_gold(silver, staging)["fact_customer_churn"])


def _missing_ids(spark, d, keep: bool, on_conflict: str = "own"):
    """Facts of records of which every tenth lacks its id, filled with the median or kept NULL."""
    staging = Staging(spark)
    ctx = replace(RUN, on_conflict=on_conflict, impute_exclude=("customerid",) if keep else ())
    raw = subscriber_raw(spark, d, missing_ids=True)
    if keep:
        raw = lowercase_names(raw)
    silver = staging.table(build_silver(build_bronze(raw, ctx), ctx))
    return comparable(_gold(silver, staging, ctx)["fact_customer_churn"])


def q_fact_missing_ids(spark, d):
    return _missing_ids(spark, d, keep=False)


def q_fact_missing_ids_kept(spark, d):
    return _missing_ids(spark, d, keep=True)


def q_fact_missing_ids_fanout(spark, d):
    return _missing_ids(spark, d, keep=False, on_conflict="fanout")


def _conflicting_gold(spark, d, on_conflict):
    staging, ctx = Staging(spark), replace(RUN, on_conflict=on_conflict)
    raw = subscriber_raw(spark, d, corrected=True)
    silver = staging.table(build_silver(build_bronze(raw, ctx), ctx))
    return _gold(silver, staging, ctx)


def q_fact_fanout(spark, d):
    """Customers with two dimension rows: each of their facts meets both."""
    return comparable(_conflicting_gold(spark, d, "fanout")["fact_customer_churn"])


def q_fact_conflict_pick(spark, d):
    return comparable(_conflicting_gold(spark, d, "pick")["fact_customer_churn"])


def q_fact_conflict_own(spark, d):
    """Customers with two dimension rows: each fact meets the one it comes from."""
    return comparable(_conflicting_gold(spark, d, "own")["fact_customer_churn"])


# --- reports -----------------------------------------------------------------------------------

def q_churn_rate_report(spark, d):
    return churn_rate_report(_standard_gold(spark, d))


def q_churn_rate_report_sql(spark, d):
    return churn_rate_report_sql(spark, _standard_gold(spark, d))


# --- checks ------------------------------------------------------------------------------------

_ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def q_counts_by_table(spark, d):
    return C.row_counts({t: table(spark, d, t) for t in _ALL_TABLES})


def q_check_not_empty(spark, d):
    reports = [C.check_not_empty(table(spark, d, t), t) for t in _ALL_TABLES]
    none = table(spark, d, "region").where(F.col("r_name").isNull())
    return C.union_reports([*reports, C.check_not_empty(none, "unnamed_region")])


def q_check_unique(spark, d):
    def check(name: str, *keys: str) -> DataFrame:
        return C.check_unique(table(spark, d, name), name, keys)

    return C.union_reports([
        check("lineitem", "l_orderkey", "l_linenumber"), check("orders", "o_orderkey"),
        check("orders", "o_custkey"), check("documents", "text"),
    ])


def q_check_fk(spark, d):
    def check(name: str, column: str, dim: str, dim_column: str) -> DataFrame:
        return C.check_foreign_key(
            table(spark, d, name), name, column, table(spark, d, dim), dim_column
        )

    return C.union_reports([
        check("orders", "o_custkey", "customer", "c_custkey"),
        check("lineitem", "l_partkey", "part", "p_partkey"),
        check("documents", "doc_id", "labels", "doc_id"),
        check("events", "user_id", "customer", "c_custkey"),
    ])


def q_check_fk_colocated(spark, d):
    """The same checks on tables written in buckets of one layout."""
    staging = Staging(spark)

    def check(name: str, column: str, dim: str, dim_column: str) -> DataFrame:
        rows = table(spark, d, name).select(F.col(column).cast("bigint").alias(column))
        keys = table(spark, d, dim).select(F.col(dim_column).cast("bigint").alias(dim_column))
        layout = co_locate(rows, [column], staging, buckets=8, hot_rows=100_000)
        known = layout.renamed(dim_column).one(keys)
        return check_co_located_key(layout.many(rows), name, column, known, dim_column)

    return C.union_reports([
        check("orders", "o_custkey", "customer", "c_custkey"),
        check("lineitem", "l_partkey", "part", "p_partkey"),
        check("documents", "doc_id", "labels", "doc_id"),
        check("events", "user_id", "customer", "c_custkey"),
    ])


def q_check_not_null(spark, d):
    raw = _raw(spark, d)
    return C.check_not_null(raw, "subscriber_raw", raw.columns)


def q_check_domain(spark, d):
    return C.union_reports([
        C.check_domain(table(spark, d, "customer"), "customer", {
            "c_mktsegment": 9, "c_acctbal": (5, 2),
        }),
        C.check_domain(table(spark, d, "orders"), "orders", {
            "o_orderpriority": 8, "o_totalprice": (7, 2),
        }),
        C.check_domain(table(spark, d, "documents"), "documents", {"text": 2000, "lang": 2}),
    ])


def q_layer_constraints(spark, d):
    staging = Staging(spark)
    bronze = staging.table(_bronze(spark, d))
    silver = staging.table(build_silver(bronze, RUN))
    gold = _gold(silver, staging)
    return C.union_reports([
        bronze_constraints(bronze), silver_constraints(silver), gold_constraints(gold),
    ])


# --- across loads ------------------------------------------------------------------------------

def _two_loads(spark: SparkSession, d: str) -> list[DataFrame]:
    """A delivery and the next one, which repeats it with some ages corrected."""
    return [lowercase_names(subscriber_raw(spark, d, corrected=c)) for c in (False, True)]


def q_dedupe_two_loads(spark, d):
    """Rows that a ledger lets through, load by load: together they are distinct."""
    staging = Staging(spark)
    ledger = RowLedger(spark, staging.folder(), buckets=16)
    first, second = [
        ledger.accept(df, f"load-{i}", staging).withColumn("load", F.lit(i)) for i, df in enumerate(_two_loads(spark, d))
    ]
    return comparable(first.unionByName(second))


_CUSTOMER_KEY = ["customer_id_anonymized", "age", "gender", "tenure"]


def q_dim_customer_stable(spark, d):
    """Customer keys after two refreshes: old ones as they were, new ones from the last on."""
    staging = Staging(spark)
    silvers = [
        build_silver(build_bronze(subscriber_raw(spark, d, corrected=c), RUN), RUN) for c in (False, True)
    ]
    keys = silvers[0].select(*_CUSTOMER_KEY).schema
    registry = KeyRegistry(spark, staging.folder(), keys, "customer_sk")
    for i, silver in enumerate(silvers):
        registry.add(silver, f"refresh-{i}", staging)
    return registry.entries()


def q_medians_two_loads(spark, d):
    """Medians over two loads from the sum of their histograms."""
    staging = Staging(spark)
    loads = [staging.table(df) for df in _two_loads(spark, d)]
    names = numeric_columns(loads[0])
    state = RankState(spark, staging.folder(), loads[0].select(*names).schema)
    for i, df in enumerate(loads):
        state.add(df, f"load-{i}")
    return state.medians(loads)


def q_lineitem_medians_two_loads(spark, d):
    """Wide and fractional columns, one load per line status."""
    staging, columns = Staging(spark), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
    lines = table(spark, d, "lineitem")
    loads = [lines.where(F.col("l_linestatus") == "F"), lines.where(~F.col("l_linestatus").eqNullSafe("F"))]
    state = RankState(spark, staging.folder(), lines.select(*columns).schema)
    for i, df in enumerate(loads):
        state.add(df, f"load-{i}")
    return state.medians(loads)


def q_customer_history(spark, d):
    """Two snapshots of all customers: some unchanged, some older, some gone, some new."""
    staging, key = Staging(spark), "customer_id_anonymized"
    attributes = ["age", "gender", "tenure", "contract_type"]
    later = replace(RUN, run_ts=datetime(2024, 2, 1, tzinfo=timezone.utc))

    def snapshot(corrected: bool, absent: str) -> DataFrame:
        """Without the customers of a contract that starts later, or has ended."""
        raw = subscriber_raw(spark, d, corrected=corrected)
        delivered = raw.where(~F.col("ContractType").eqNullSafe(F.lit(absent)))
        silver = build_silver(build_bronze(delivered, RUN), RUN)
        return staging.table(one_per_customer(silver, key, attributes, ["tenure"]))

    history = staging.table(next_history(None, snapshot(False, " One-Year"), key, attributes, RUN.now()))
    return comparable(next_history(history, snapshot(True, "TWO-YEAR "), key, attributes, later.now()))


# --- stores and whole runs ---------------------------------------------------------------------

def q_layer_roundtrip(spark, d):
    """Fact written in folders by churn flag, and read back."""
    staging = Staging(spark)
    gold = _gold(staging.table(_silver(spark, d)), staging)
    store = LayerStore(spark, staging.folder())
    store.write(
        gold["fact_customer_churn"], "gold", "fact_customer_churn", RUN.version, ["is_churned"]
    )
    return comparable(store.read("gold", "fact_customer_churn"))


def q_run_missing_ids(spark, d):
    """Facts lost and added, when every customer key meets all its dimension rows."""
    store, ctx = LayerStore(spark, Staging(spark).folder()), replace(RUN, on_conflict="fanout")
    return run_layers(spark, subscriber_raw(spark, d, missing_ids=True), store, ctx)


def q_layer_reset(spark, d):
    """Rows of the newest version after a write, after a reset and after the next write."""
    store = LayerStore(spark, Staging(spark).folder())
    bronze = _bronze(spark, d)

    def size(step: str) -> DataFrame:
        rows = store.read("bronze", "subscribers").agg(F.count(F.lit(1)).alias("row_count"))
        return rows.select(F.lit(step).alias("step"), "row_count")

    store.write(bronze, "bronze", "subscribers", "v1")
    written = size("written")
    store.reset("bronze", "subscribers", "v2")
    emptied = size("reset")
    store.write(bronze, "bronze", "subscribers", "v3")
    return written.unionByName(emptied).unionByName(size("rewritten"))


def _run(spark: SparkSession, d: str) -> tuple[LayerStore, DataFrame]:
    store = LayerStore(spark, Staging(spark).folder())
    raw = read_csv_raw(spark, _csv_folder(spark, d))
    return store, run_layers(spark, raw, store, RUN)


def q_stage_metrics(spark, d):
    return _run(spark, d)[1]


def q_end_to_end_report(spark, d):
    return churn_rate_report(_run(spark, d)[0].gold())


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): fn for name, fn in list(globals().items()) if name.startswith("q_")
}
