from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas as S
from stratalake.context import RunContext
from stratalake.operators.checks import ConstraintViolation
from stratalake.plans import gold as G
from stratalake.plans.bronze import build_bronze
from stratalake.plans.report import churn_rate_report, churn_rate_report_sql
from stratalake.plans.run import (
    load_bronze, load_gold, load_silver, run_layers, validate_gold,
)
from stratalake.plans.silver import build_silver
from stratalake.sources.layers import LayerStore
from stratalake.sources.staging import Staging, clear_staged, staged_results
from stratalake.streaming.refresh import SchemaDrift, refresh_silver
from stratalake.workload.subscribers import subscriber_raw

SF_DIR = "/root/testdata/sf0.001"
CTX = RunContext(
    run_id="test", run_ts=datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc),
    source_file="/data/in/file.csv",
)


def raw_rows(spark, *rows):
    """Raw records given as overrides of a plain one."""
    plain = {
        "CustomerID": 1, "Age": 40, "Gender": "Male", "Tenure": 10,
        "MonthlyCharges": Decimal("10.00"), "ContractType": "One-Year", "InternetService": "DSL",
        "TotalCharges": Decimal("100.00"), "TechSupport": "Yes", "Churn": "No",
    }
    filled = [[(plain | row)[name] for name in S.RAW.names] for row in rows]
    return spark.createDataFrame(filled, S.RAW)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bronze ------------------------------------------------------------------------------------

def test_rows_equal_only_after_filling_both_stay(spark):
    raw = raw_rows(spark, {"Gender": None}, {"Gender": "Unknown"}, {}, {}, {"Age": None})
    bronze = build_bronze(raw, CTX)
    assert bronze.count() == 4
    assert bronze.where("gender = 'Unknown'").count() == 2
    assert bronze.where("age = 40").count() == 4


def test_bronze_fills_the_id_unless_excluded(spark):
    raw = raw_rows(spark, {"CustomerID": 1}, {"CustomerID": 4}, {"CustomerID": None})
    assert sorted(r[0] for r in build_bronze(raw, CTX).select("customerid").collect()) == [1, 3, 4]
    kept = build_bronze(raw, replace(CTX, impute_exclude=("customerid",)))
    assert kept.where("customerid is null").count() == 1


def test_bronze_stamps_are_neither_compared_nor_filled(spark):
    bronze = build_bronze(raw_rows(spark, {}, {}), CTX)
    assert [f.name for f in bronze.schema] == S.BRONZE.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in S.BRONZE]
    row = bronze.first()
    assert (row["source_file"], row["pipeline_run_id"]) == ("file.csv", "test")
    assert bronze.select(F.unix_timestamp("ingestion_timestamp")).first()[0] == int(
        CTX.run_ts.timestamp()
    )


def test_bronze_copies_and_file_column(spark):
    raw = raw_rows(spark, {}, {}, {"Age": None}).withColumn(
        "from_file", F.concat(F.lit("f"), F.monotonically_increasing_id().cast("string"))
    )
    bronze = build_bronze(raw, CTX, copies="_copies", file_column="from_file")
    assert sorted(r["_copies"] for r in bronze.collect()) == [1, 2]
    assert "from_file" not in bronze.columns and bronze.where("source_file like 'f%'").count() == 2


def executed_lines(df):
    """Lines of the plan as it ran: nested initial plans left out."""
    lines, initial_at = [], None
    for line in plan_of(df).splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if initial_at is not None and depth >= initial_at:
            continue
        initial_at = None
        if "== Initial Plan ==" in line:
            initial_at = depth
        else:
            lines.append(line)
    return lines


@pytest.mark.parametrize("copies", [None, "_copies"])
def test_bronze_scans_and_shuffles_its_rows_once(spark, copies):
    with Staging(spark) as staging:
        bronze = build_bronze(staging.table(subscriber_raw(spark, SF_DIR)), CTX, copies)
        bronze.collect()
        ran = executed_lines(bronze)
        reused = [line for line in ran if "ReusedExchange" in line]
        scans = [line for line in ran if "FileScan" in line]
        # Rows, second pass and the first pass's histogram all take up an earlier shuffle.
        assert (len(scans), len(reused)) == (1, 3), "\n".join(line[:150] for line in ran)


# --- silver ------------------------------------------------------------------------------------

def test_silver_schema_score_and_privacy(spark):
    silver = build_silver(build_bronze(raw_rows(spark, {}, {"CustomerID": 2}), CTX), CTX)
    assert silver.schema.names == S.SILVER.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in S.SILVER]
    assert {r["data_quality_score"] for r in silver.collect()} == {Decimal("1.00")}


def test_score_counts_audit_and_derived_columns(spark):
    bronze = build_bronze(raw_rows(spark, {"Age": None, "Tenure": None}), CTX)
    # 15 columns, of which age and tenure stay empty for want of any value.
    assert build_silver(bronze, CTX).first()["data_quality_score"] == Decimal("0.87")


def test_silver_tolerates_drift(spark):
    bronze = build_bronze(raw_rows(spark, {}), CTX)
    senior = bronze.withColumnsRenamed({"age": "SeniorCitizen", "contracttype": "Contract"})
    silver = build_silver(senior, CTX).first()
    assert (silver["age"], silver["contract_type"]) == (40, "one-year")
    bare = build_silver(bronze.drop("age", "techsupport"), CTX)
    assert bare.first()["age"] is None and "tech_support" not in bare.columns
    both = bronze.withColumn("contract", F.lit("Two-Year"))
    assert build_silver(both, CTX).first()["contract_type"] == "two-year"
    with pytest.raises(ValueError, match="contract_type"):
        build_silver(both, CTX, on_collision="error")


def test_pseudonym_does_not_depend_on_the_stored_type(spark):
    bronze = build_bronze(raw_rows(spark, {}), CTX)
    as_double = bronze.withColumn("customerid", F.col("customerid").cast("double"))
    assert (
        build_silver(as_double, CTX).first()["customer_id_anonymized"]
        == build_silver(bronze, CTX).first()["customer_id_anonymized"] == "6b86b273ff34fce1"
    )


def test_silver_is_row_local(spark):
    with Staging(spark) as staging:
        bronze = staging.table(build_bronze(raw_rows(spark, {}), CTX))
        plan = plan_of(build_silver(bronze, CTX))
        assert "Exchange" not in plan and "Python" not in plan
        narrow = plan_of(build_silver(bronze, CTX).select("churn"))
        assert "ReadSchema: struct<churn:string>" in narrow


# --- gold --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = LayerStore(spark, str(tmp_path_factory.mktemp("lake")))
    run_layers(spark, subscriber_raw(spark, SF_DIR), made, CTX)
    return made


def test_gold_schemas_and_invariants(store):
    gold = store.gold()
    for table, df in gold.items():
        assert df.schema == S.TABLES[("gold", table)]
    fact = gold["fact_customer_churn"]
    rows = fact.count()
    assert rows == store.read("silver", "subscribers").count()
    for df, sk in ((fact, "fact_sk"), (gold["dim_customer"], "customer_sk"),
                   (gold["dim_service"], "service_sk"), (gold["dim_contract"], "contract_sk")):
        low, high, distinct, n = df.agg(
            F.min(sk), F.max(sk), F.count_distinct(sk), F.count(F.lit(1))
        ).first()
        assert (low, high, distinct) == (1, n, n)


def test_reports_agree(spark, store):
    gold = store.gold()
    frame, text = churn_rate_report(gold).collect(), churn_rate_report_sql(spark, gold).collect()
    assert frame == text and len(frame) == 12
    rates = [r["churn_rate_percent"] for r in frame]
    assert rates == sorted(rates, reverse=True)


def test_fact_plan(spark, store):
    """Label dimensions are broadcast, the customer dimension is not; no task gets the table."""
    with Staging(spark) as staging:
        gold = store.gold()
        silver = store.read("silver", "subscribers", row_id="_row")
        tagged = silver.withColumn("_tag", F.col("_row"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = plan_of(G.fact_rows(tagged, gold, CTX, staging).select(*G.FACT_ORDER, "_tag"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
        assert "SinglePartition" not in plan and "Python" not in plan


def test_label_dimensions_beyond_the_bound_are_shuffled(spark, store, monkeypatch):
    with Staging(spark) as staging:
        gold, silver = store.gold(), store.read("silver", "subscribers")
        usual = G.build_fact(silver, gold, CTX, staging).drop("fact_sk").collect()
        monkeypatch.setattr(G, "all_fit_broadcast", lambda tables: [False] * len(tables))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "BroadcastHashJoin" not in plan_of(G.fact_rows(silver, gold, CTX, staging))
            shuffled = G.build_fact(silver, gold, CTX, staging).drop("fact_sk").collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert sorted(map(repr, usual)) == sorted(map(repr, shuffled))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_gold_does_not_depend_on_partitioning(spark, store, tmp_path, adaptive):
    def table_sets(gold):
        return {t: sorted(map(repr, df.collect())) for t, df in gold.items()}

    other = LayerStore(spark, str(tmp_path / "lake"))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        shuffled = subscriber_raw(spark, SF_DIR).orderBy(F.rand(3)).repartition(5)
        run_layers(spark, shuffled, other, CTX)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert table_sets(other.gold()) == table_sets(store.gold())


def test_fan_out_and_its_alternatives(spark):
    raw = raw_rows(spark, {"Age": 1}, {"Age": 2}, {"CustomerID": 2})
    with Staging(spark) as staging:
        def fact(on_conflict):
            ctx = replace(CTX, on_conflict=on_conflict)
            silver = staging.table(build_silver(build_bronze(raw, ctx), ctx))
            dims = {
                "dim_customer": staging.table(G.build_dim_customer(silver, ctx)),
                "dim_service": staging.table(G.build_dim_service(silver, staging)),
                "dim_contract": staging.table(G.build_dim_contract(silver, staging)),
            }
            return G.build_fact(silver, dims, ctx, staging)

        assert fact("fanout").count() == 5
        assert fact("pick").count() == 3
        with pytest.raises(PySparkException, match="several customer_sk"):
            fact("error")


@pytest.mark.parametrize("null_safe", [False, True])
def test_fanned_out_facts_are_numbered_without_being_staged(spark, null_safe):
    """An id of many facts and many customers, one with customers only, facts without an id."""
    ctx = replace(CTX, on_conflict="fanout", null_safe_lookup=null_safe)
    people = [("hot", i % 300, "x", 1) for i in range(700)] + [(None, i, "x", 1) for i in range(3)]
    rows = [
        (key, age, gender, tenure, Decimal(i % 11), "m", "dsl", Decimal(i % 7) if i % 5 else None, "yes", "no", None)
        for i, (key, age, gender, tenure) in enumerate([*people, *people[:20], ("one", 5, "y", 2)])
    ]
    silver = spark.createDataFrame(rows, T.StructType(S.SILVER.fields[:11])).repartition(3)

    class Sized(Staging):
        def table(self, df):
            table = super().table(df)
            sizes.append(table.count())
            return table

    sizes = []
    with Sized(spark) as staging:
        silver = staging.table(silver)
        dims = {
            "dim_customer": staging.table(G.build_dim_customer(
                silver.unionByName(silver.limit(1).withColumn("customer_id_anonymized", F.lit("idle"))), ctx
            )),
            "dim_service": staging.table(G.build_dim_service(silver, staging)),
            "dim_contract": staging.table(G.build_dim_contract(silver, staging)),
        }
        fact = G.build_fact(silver, dims, ctx, staging, marked=True).cache()
        kept = fact.drop("fact_sk", "created_timestamp", "updated_timestamp", "date_sk").orderBy("fact_sk")
        plain = G.fact_rows(silver, dims, ctx, staging).select(*G.FACT_ORDER, "_first")
        customers = dims["dim_customer"].count()
        pairs = 720 * 300 + 1 + (9 if null_safe else 0)
        matched = 721 + (3 if null_safe else 0)
        assert fact.count() == plain.count() == pairs
        assert fact.where("_first").count() == plain.where("_first").count() == matched
        numbers = fact.agg(F.min("fact_sk"), F.max("fact_sk"), F.countDistinct("fact_sk")).first()
        assert tuple(numbers) == (1, pairs, pairs)
        got, expected = ([repr(r[:-1]) for r in rows.collect()] for rows in (kept, plain.orderBy(*G.FACT_ORDER)))
        assert got == expected
        assert customers < 310 and max(sizes) <= len(rows)


# --- whole runs --------------------------------------------------------------------------------

def test_metrics_and_cleanup(spark, store, tmp_path):
    import os

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    metrics = run_layers(
        spark, subscriber_raw(spark, SF_DIR), LayerStore(spark, str(tmp_path / "lake")), CTX
    )
    assert [tuple(r) for r in metrics.collect()] == [
        ("bronze", "subscribers", 150, 14, None, None), ("silver", "subscribers", 150, None, None, None),
        ("gold", "dim_customer", 150, None, None, None), ("gold", "dim_service", 9, None, None, None),
        ("gold", "dim_contract", 4, None, None, None), ("gold", "fact_customer_churn", 150, None, 0, 0),
    ]
    assert set(os.listdir(shared)) == before


def test_empty_source_fails_validation_and_is_taken_back(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, raw_rows(spark, {}), store, CTX)
    later = replace(CTX, run_ts=CTX.run_ts + timedelta(hours=1))
    empty = raw_rows(spark, {}).limit(0)
    with pytest.raises(ConstraintViolation, match="fact_customer_churn: not_empty"):
        run_layers(spark, empty, store, later)
    assert store.versions("gold", "dim_customer")[-1] == later.version
    assert store.gold()["fact_customer_churn"].count() == 1


def test_no_reader_sees_a_version_before_it_is_checked(spark, tmp_path, monkeypatch):
    """Gold is read while a failing run is at its checks, by stages and whole."""
    import stratalake.plans.run as R

    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, raw_rows(spark, {}), store, CTX)
    seen, checks = [], R.gold_not_empty

    def watched(gold):
        seen.append((store.newest_shared("gold", S.GOLD_TABLES), store.gold()["fact_customer_churn"].count()))
        return checks(gold)

    monkeypatch.setattr(R, "gold_not_empty", watched)
    for hours, whole in ((1, True), (2, False)):
        later = replace(CTX, run_ts=CTX.run_ts + timedelta(hours=hours))
        empty = raw_rows(spark, {}).limit(0)
        with pytest.raises(ConstraintViolation):
            if whole:
                run_layers(spark, empty, store, later)
            else:
                load_bronze(empty, store, later)
                load_silver(store, later)
                load_gold(store, later)
    assert seen == [(CTX.version, 1)] * 2
    assert store.versions("gold", "fact_customer_churn") == [CTX.version]


def test_validation_hides_a_version_that_fails(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, raw_rows(spark, {}), store, CTX)
    assert all(r["violations"] == 0 for r in validate_gold(store))
    later = replace(CTX, run_ts=CTX.run_ts + timedelta(hours=1))
    run_layers(spark, raw_rows(spark, {}), store, later)
    broken = store.read("gold", "fact_customer_churn", CTX.version).withColumn("service_sk", F.lit(99))
    store.write(broken, "gold", "fact_customer_churn", later.version)
    with pytest.raises(ConstraintViolation, match="foreign_key"):
        validate_gold(store)
    assert store.newest_shared("gold", S.GOLD_TABLES) == CTX.version


def test_bronze_and_silver_checks_are_logged(spark, tmp_path, caplog):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, raw_rows(spark, {"Gender": "x" * 30}, {"Age": 3}), store, CTX)
    assert "bronze: domain(gender text(20)) has 1 violations" in caplog.text
    assert "silver: unique(customer_id_anonymized) has 1 violations" in caplog.text


@pytest.mark.parametrize("options, facts, lost, added", [
    ({}, 4, 0, 0), ({"impute_exclude": ("CustomerID",)}, 4, 0, 0),
    ({"on_conflict": "fanout"}, 16, 0, 12), ({"on_conflict": "pick"}, 4, 0, 0),
    ({"on_conflict": "fanout", "impute_exclude": ("CustomerID",)}, 1, 3, 0),
])
def test_facts_of_records_without_ids(spark, tmp_path, options, facts, lost, added):
    """Three records without an id, of which the median makes the customer of the fourth."""
    raw = raw_rows(spark, {}, *({"CustomerID": None, "Age": age} for age in (20, 30, 31)))
    store = LayerStore(spark, str(tmp_path / "lake"))
    fact = run_layers(spark, raw, store, replace(CTX, **options)).collect()[-1]
    assert (fact["row_count"], fact["facts_lost"], fact["facts_added"]) == (facts, lost, added)


def test_run_without_ids_writes_the_product_in_parts(spark, tmp_path, monkeypatch):
    """800 records that get one id, of 60 ages: the run stages no product, and no task gives much of it."""
    import stratalake.plans.run as R

    sizes = []

    class Sized(Staging):
        def table(self, df):
            table = super().table(df)
            sizes.append(table.count())
            return table

    monkeypatch.setattr(R, "Staging", Sized)
    for name, value in (("_FACT_BLOCK", 32), ("_PEOPLE_BLOCK", 8), ("_FANNED_ROWS", 3_000)):
        monkeypatch.setattr(G, name, value)
    raw = raw_rows(spark, {"Age": 0}, *(
        {"CustomerID": None, "Age": i % 60, "MonthlyCharges": Decimal(i)} for i in range(800)
    ))
    store = LayerStore(spark, str(tmp_path / "lake"))
    fact = run_layers(spark, raw, store, replace(CTX, on_conflict="fanout")).collect()[-1]
    assert (fact["row_count"], fact["facts_lost"], fact["facts_added"]) == (801 * 60, 0, 801 * 59)
    assert max(sizes) == 801
    files = spark.read.parquet(store.path("gold", "fact_customer_churn", CTX.version)).select(
        "fact_sk", F.col("_metadata.file_path").alias("file")
    )
    rows = [r["count"] for r in files.groupBy("file").count().collect()]
    assert len(rows) > 8 and max(rows) < 801 * 60 // 4
    assert tuple(files.agg(F.min("fact_sk"), F.max("fact_sk"), F.countDistinct("fact_sk")).first()) == (
        1, 801 * 60, 801 * 60
    )


def test_failed_run_leaves_the_last_gold(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, subscriber_raw(spark, SF_DIR), store, CTX)
    good = store.gold()["fact_customer_churn"].count()
    later = replace(CTX, run_ts=CTX.run_ts + timedelta(hours=1), on_conflict="error")
    twice = subscriber_raw(spark, SF_DIR, corrected=True)
    load_bronze(twice, store, later)
    load_silver(store, later)
    with pytest.raises(PySparkException, match="several customer_sk"):
        load_gold(store, later)
    assert store.versions("gold", "dim_customer")[-1] == later.version
    gold = store.gold()
    assert gold["fact_customer_churn"].count() == good == gold["dim_customer"].count()


def test_backfill_reads_its_own_layers(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(spark, subscriber_raw(spark, SF_DIR), store, CTX)
    earlier = replace(CTX, run_ts=CTX.run_ts - timedelta(days=1))
    metrics = run_layers(spark, raw_rows(spark, {}, {"CustomerID": 2}), store, earlier)
    assert {r["table_name"]: r["row_count"] for r in metrics.collect()} == {
        "subscribers": 2, "dim_customer": 2, "dim_service": 1, "dim_contract": 1,
        "fact_customer_churn": 2,
    }
    assert store.gold()["fact_customer_churn"].count() == 150


def test_fact_partitioned_by_churn(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    run_layers(
        spark, subscriber_raw(spark, SF_DIR), store, replace(CTX, fact_partition_by=("is_churned",))
    )
    assert store.gold()["fact_customer_churn"].count() == 150


def test_drifted_source_keeps_its_values_through_the_store(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    drifted = raw_rows(spark, {}, {"CustomerID": 2, "Age": None}).withColumnsRenamed(
        {"Age": "SeniorCitizen", "ContractType": "Contract"}
    )
    run_layers(spark, drifted, store, CTX)
    silver = store.read("silver", "subscribers")
    assert silver.schema == S.SILVER
    assert {(r["age"], r["contract_type"]) for r in silver.collect()} == {(40, "one-year")}
    assert "seniorcitizen" in store.read("bronze", "subscribers").columns


def test_versions_sort_by_time():
    earlier = RunContext(run_id="z", run_ts=datetime(2024, 1, 1))
    later = RunContext(run_id="a/b", run_ts=datetime(2024, 1, 1, 1, tzinfo=timezone.utc))
    assert earlier.version < later.version and "/" not in later.version


def test_streamed_silver_picks_up_new_files_once(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("bronze", "silver", "checkpoint")]
    bronze = build_bronze(raw_rows(spark, {}, {"CustomerID": 2}), CTX)

    def refresh():
        refresh_silver(spark, *paths, CTX)
        return spark.read.schema(S.SILVER).parquet(paths[1])

    bronze.write.parquet(paths[0])
    assert refresh().count() == 2
    assert refresh().count() == 2
    build_bronze(raw_rows(spark, {"CustomerID": 3}), CTX).write.mode("append").parquet(paths[0])
    streamed = refresh()
    batch = build_silver(spark.read.schema(S.BRONZE).parquet(paths[0]), CTX)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_streamed_refresh_refuses_other_columns(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("bronze", "silver", "checkpoint")]
    bronze = build_bronze(raw_rows(spark, {}), CTX)
    bronze.write.parquet(paths[0])
    refresh_silver(spark, *paths, CTX)
    for n, other in enumerate((
        bronze.withColumnRenamed("age", "seniorcitizen"), bronze.drop("churn"), bronze.withColumn("more", F.lit(1)),
    )):
        folder = str(tmp_path / f"other{n}")
        bronze.write.parquet(folder)
        other.write.mode("append").parquet(folder)
        with pytest.raises(SchemaDrift):
            refresh_silver(spark, folder, *paths[1:], CTX)
    with pytest.raises(SchemaDrift):
        refresh_silver(spark, *paths, CTX, schema=S.SILVER)
    assert spark.read.schema(S.SILVER).parquet(paths[1]).count() == 1


def test_staged_tables_are_cleared(spark):
    import os

    from stratalake.workload.queries import QUERIES

    shared = spark.conf.get("spark.checkpoint.dir")
    clear_staged()
    with staged_results():
        assert QUERIES["dense_key_distinct"](spark, SF_DIR).count() > 0
        assert any(name.startswith("staged-") for name in os.listdir(shared))
    assert not any(name.startswith("staged-") for name in os.listdir(shared))


def test_the_fact_takes_few_jobs(spark, store):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fact-jobs", "fact")
    try:
        with Staging(spark) as staging:
            G.build_fact(store.read("silver", "subscribers", row_id="_r"), store.gold(), CTX, staging, row_id="_r").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("fact-jobs")) <= 30
