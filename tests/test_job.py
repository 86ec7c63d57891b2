from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from stratalake.job import parse, run
from stratalake.operators.checks import ConstraintViolation
from stratalake.schemas import GOLD_TABLES
from stratalake.sources import jdbc
from stratalake.sources.layers import LayerStore
from stratalake.workload.queries import _csv_folder


@pytest.fixture(scope="module")
def source(spark):
    return _csv_folder(spark, "/root/testdata/sf0.001")


def test_stage_by_stage_equals_all(spark, source, tmp_path):
    single, whole = str(tmp_path / "single"), str(tmp_path / "whole")

    def stage(name, store):
        return list(run(spark, parse([
            name, "--store", store, "--source", source, "--run-id", "r1", "--run-ts", "2024-05-06T07:08:09",
        ])))

    steps = [row for name in ("bronze", "silver", "gold") for row in stage(name, single)]
    assert steps == stage("all", whole)
    assert steps[0] == {
        "stage": "bronze", "table_name": "subscribers", "row_count": 150, "duplicates_removed": 14,
        "facts_lost": None, "facts_added": None,
    }
    versions = [LayerStore(spark, single).versions("gold", t) for t in GOLD_TABLES]
    assert versions == [["20240506T070809000000_r1"]] * len(GOLD_TABLES)
    assert stage("report", single) == stage("report", whole)
    assert len(stage("report", single)) == 12
    assert all(row["violations"] == 0 for row in stage("validate", single))


def test_files_are_recorded_on_request(spark, source, tmp_path):
    store = str(tmp_path / "lake")
    run(spark, parse(["bronze", "--store", store, "--source", source, "--record-files"]))
    names = LayerStore(spark, store).read("bronze", "subscribers").select("source_file").distinct()
    assert all(r[0].startswith("part-") for r in names.collect())


def test_arguments():
    with pytest.raises(SystemExit):
        parse(["all", "--store", "/s"])
    with pytest.raises(SystemExit):
        parse(["nosuchstage", "--store", "/s"])
    with pytest.raises(SystemExit):
        parse(["report"])
    with pytest.raises(SystemExit):
        parse(["report", "--store", "/s", "--jdbc-url", "jdbc:x"])
    with pytest.raises(SystemExit):
        parse(["report", "--jdbc-url", "jdbc:x", "--jdbc-option", "user"])
    with pytest.raises(SystemExit):
        parse(["gold", "--store", "/s", "--customer-buckets", "4", "--on-conflict", "pick"])
    assert parse(["report", "--store", "/s"]).on_conflict == "own"
    args = parse(["report", "--store", "/s", "--keep-null", "customerid", "age"])
    assert args.keep_null == ["customerid", "age"]


def test_validate_refuses_an_empty_gold(spark, source, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for table in GOLD_TABLES:
        store.reset("gold", table, "v1")
    with pytest.raises(ConstraintViolation, match="not_empty"):
        run(spark, parse(["validate", "--store", str(tmp_path)]))
    assert store.versions("gold", "fact_customer_churn") == []


def test_bad_rows_may_be_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    header = "CustomerID,Age,Gender,Tenure,MonthlyCharges,ContractType,InternetService,TotalCharges,TechSupport,Churn"
    rows = ["1,30,x,5,10.10,a,b,50.5,c,No", "2,x,x,5,10.10,a,b,50.5,c,No,more"]
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, *rows]) + "\n")
    arguments = ["--store", str(tmp_path / "lake"), "--source", str(tmp_path / "in")]
    with pytest.raises(PySparkException):
        run(spark, parse(["bronze", *arguments]))
    run(spark, parse(["bronze", *arguments, "--on-bad", "null"]))
    bronze = LayerStore(spark, str(tmp_path / "lake")).read("bronze", "subscribers")
    assert sorted((r["customerid"], r["age"], r["unparsed_row"]) for r in bronze.collect()) == [
        (1, 30, None), (2, 30, rows[1]),
    ]


class Database:
    """Stands in for a database: remembers the order of writes, and keeps what was written."""

    def __init__(self):
        self.tables, self.log = {}, []

    def read_table(self, spark, connection, table, split=None):
        assert connection["url"] == "jdbc:test" and connection["user"] == "me"
        rows, schema = self.tables[table]
        return spark.createDataFrame(rows, schema)

    def write_table(self, df, connection, table, mode="overwrite", **options):
        rows = df.collect()
        self.tables[table] = rows, df.schema
        self.log.append((table, len(rows)))

    def reset_table(self, df, connection, table):
        self.tables[table] = [], df.schema
        self.log.append((table, 0))


def test_relational_layers_by_stage(spark, source, tmp_path, monkeypatch):
    """Empty fact, dimensions, fact. A round trip would need a database; the calls are recorded."""
    database = Database()
    for name in ("read_table", "write_table", "reset_table"):
        monkeypatch.setattr(jdbc, name, getattr(database, name))
    arguments = ["--source", source, "--run-id", "r1", "--jdbc-url", "jdbc:test", "--jdbc-option", "user=me"]
    for stage in ("bronze", "silver", "gold"):
        run(spark, parse([stage, *arguments]))
    fact = "gold.fact_customer_churn"
    assert database.log == [
        ("bronze.subscribers", 150), ("silver.subscribers", 150), (fact, 0), ("gold.dim_customer", 150),
        ("gold.dim_service", 9), ("gold.dim_contract", 4), (fact, 150),
    ]
    folder = str(tmp_path / "lake")
    list(run(spark, parse(["all", "--store", folder, "--source", source, "--run-id", "r1"])))
    report = list(run(spark, parse(["report", "--jdbc-url", "jdbc:test", "--jdbc-option", "user=me"])))
    assert report == list(run(spark, parse(["report", "--store", folder])))
    # A gold that does not hold up never reaches the fact table.
    database.tables["silver.subscribers"] = [], database.tables["silver.subscribers"][1]
    with pytest.raises(ConstraintViolation):
        run(spark, parse(["gold", *arguments]))
    assert database.tables[fact][0] == []
