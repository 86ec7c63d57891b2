from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas as S
from stratalake.sources import jdbc
from stratalake.sources.csv import read_csv_raw, typed
from stratalake.sources.layers import LayerStore
from stratalake.sources.staging import Staging, shared_folder

HEADER = ",".join(S.RAW.names)


def write(folder, name, *lines, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


# --- CSV ---------------------------------------------------------------------------------------

def test_csv_words_types_and_quotes(spark, tmp_path):
    path = write(
        tmp_path / "in", "a.csv",
        '1,30,"Male, or so",5,10.10,One-Year,DSL,50.5,Yes,No',
        "2,NA,N/A,5.0,None,null, dsl ,,n/a,\"say \"\"hi\"\"\"",
    )
    df = read_csv_raw(spark, path)
    assert [f.dataType for f in df.schema] == [f.dataType for f in S.RAW]
    assert sorted(map(tuple, df.collect())) == [
        (1, 30, "Male, or so", 5, Decimal("10.10"), "One-Year", "DSL", Decimal("50.50"), "Yes", "No"),
        (2, None, None, 5, None, None, " dsl ", None, None, 'say "hi"'),
    ]


def test_csv_bad_number(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", "1,old,x,1,1,x,x,1,x,x", "2,1.5,x,1, ,x,x,1,x,x")
    with pytest.raises(PySparkException, match="Age: not int: (old|1.5)"):
        read_csv_raw(spark, path).collect()
    lenient = read_csv_raw(spark, path, on_bad="null")
    assert [tuple(r) for r in lenient.select("Age", "MonthlyCharges").orderBy("CustomerID").collect()] \
        == [(None, Decimal("1.00")), (None, None)]
    with pytest.raises(ValueError, match="on_bad"):
        read_csv_raw(spark, path, on_bad="?")


def test_csv_variant_columns_and_extra_text(spark, tmp_path):
    path = write(
        tmp_path / "in", "a.csv", "1,0,Two-Year,hello", header="CustomerID,SeniorCitizen,Contract,Note"
    )
    df = read_csv_raw(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "int", "string", "string"]


def test_csv_inferred_types(spark, tmp_path):
    path = write(
        tmp_path / "in", "a.csv", "1,1.5,3000000000,x,NA,1e40,1.234", "NA,2,4,5,NA,2,2",
        header="i,d,l,t,n,f,p",
    )
    df = read_csv_raw(spark, path, types="infer")
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "i": "int", "d": "decimal(18,2)", "l": "bigint", "t": "string", "n": "string",
        "f": "double", "p": "double",
    }


def test_csv_rows_of_other_lengths(spark, tmp_path):
    path = write(
        tmp_path / "in", "a.csv", "1,Male,a,b,Yes", '2,"x,""y""",c,No', "3,short", '4,"p,q",r,s,"t,u"',
        header="CustomerID,Gender,Note,Churn",
    )
    with pytest.raises(PySparkException, match="more than 4 fields: (1|4)"):
        read_csv_raw(spark, path).select("Note").collect()
    df = read_csv_raw(spark, path, on_bad="null")
    assert sorted(map(tuple, df.collect())) == [
        (1, "Male", "a", "b", "1,Male,a,b,Yes"), (2, 'x,"y"', "c", "No", None),
        (3, "short", None, None, None), (4, "p,q", "r", "s", '4,"p,q",r,s,"t,u"'),
    ]
    assert df.select("Gender").count() == 4
    short = write(tmp_path / "short", "a.csv", "3,short", header="CustomerID,Gender,Note")
    assert [tuple(r) for r in read_csv_raw(spark, short).collect()] == [(3, "short", None)]


def test_csv_digits_are_never_rounded(spark, tmp_path):
    path = write(
        tmp_path / "in", "a.csv", "1.000000000004,0.00000000001,5.00,1.2300", "2,1,5e2,-.50", header="a,b,c,d"
    )
    df = read_csv_raw(spark, path, types="infer")
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "double", "int", "decimal(18,2)"]
    assert sorted(map(tuple, df.collect())) == [
        (1.000000000004, 1e-11, 5, Decimal("1.23")), (2.0, 1.0, 500, Decimal("-0.50")),
    ]
    for types, text in (({"a": T.IntegerType()}, "5.00000000001"), ({"a": T.DecimalType(10, 2)}, "5.001")):
        path = write(tmp_path / text, "a.csv", text, "7", header="a")
        with pytest.raises(PySparkException, match=f"a: not .*: {text}"):
            read_csv_raw(spark, path, types=types).collect()
        kept = read_csv_raw(spark, path, types=types, on_bad="null").select("a").collect()
        assert [r["a"] is None for r in kept].count(True) == 1


def test_csv_several_files(spark, tmp_path):
    row = "1,30,x,5,10.10,a,b,50.5,c,d"
    write(tmp_path / "in", "a.csv", row)
    path = write(tmp_path / "in", "b.csv", row)
    df = read_csv_raw(spark, path, file_column="file")
    assert sorted(r["file"] for r in df.collect()) == ["a.csv", "b.csv"]
    write(tmp_path / "in", "c.csv", "1", header="CustomerID")
    with pytest.raises(Exception, match="Number of column in CSV header"):
        read_csv_raw(spark, path).collect()


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", '1,"two\nlines"', header="id,note")
    assert read_csv_raw(spark, path, multi_line=True).first()["note"] == "two\nlines"


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv_raw(spark, str(tmp_path / "nothing"))


# --- layer store -------------------------------------------------------------------------------

def contract_rows(spark, n):
    return spark.range(1, n + 1).select(
        F.concat(F.lit("c"), "id").alias("contract_type"), F.col("id").alias("contract_sk"),
        F.lit(1).alias("contract_duration_months"), F.lit("extra").alias("unwanted"),
    )


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "lake"))


def test_write_counts_and_conforms(spark, store):
    seen = store.write(
        contract_rows(spark, 5), "gold", "dim_contract", "v1",
        metrics={"top": F.max("contract_sk")},
    )
    assert seen == {"rows": 5, "top": 5}
    df = store.read("gold", "dim_contract")
    assert df.schema == S.DIM_CONTRACT and df.count() == 5


def test_newest_committed_version_wins(spark, store, tmp_path):
    store.write(contract_rows(spark, 1), "gold", "dim_contract", "v1")
    store.write(contract_rows(spark, 2), "gold", "dim_contract", "v2")
    (tmp_path / "lake" / "gold" / "dim_contract" / "v3").mkdir()
    assert store.versions("gold", "dim_contract") == ["v1", "v2"]
    assert store.read("gold", "dim_contract").count() == 2
    assert store.read("gold", "dim_contract", "v1").count() == 1


def test_failed_write_keeps_the_last_version(spark, store):
    store.write(contract_rows(spark, 3), "gold", "dim_contract", "v1")
    broken = contract_rows(spark, 3).withColumn(
        "contract_type", F.raise_error(F.lit("broken source")).cast("string")
    )
    with pytest.raises(PySparkException, match="broken source"):
        store.write(broken, "gold", "dim_contract", "v2")
    assert store.versions("gold", "dim_contract") == ["v1"]
    assert store.read("gold", "dim_contract").count() == 3


def test_reset(spark, store):
    store.write(contract_rows(spark, 3), "gold", "dim_contract", "v1")
    store.reset("gold", "dim_contract", "v2")
    empty = store.read("gold", "dim_contract")
    assert empty.count() == 0 and empty.schema == S.DIM_CONTRACT


def test_expire_keeps_what_readers_can_use(spark, store):
    for version in ("v1", "v2"):
        store.define(version, replace=True)
    # Unfinished later runs: dimensions without a fact.
    for version in ("v3", "v4"):
        store.reset("gold", "dim_contract", version)
    deleted = store.expire("gold", keep=1)
    assert sorted(deleted) == [(t, "v1") for t in sorted(S.GOLD_TABLES)]
    assert store.versions("gold", "dim_contract") == ["v2", "v3", "v4"]
    assert store.shared_versions("gold", S.GOLD_TABLES) == ["v2"]
    assert store.expire("gold", keep=5) == [] and len(store.versions("silver", "subscribers")) == 2
    with pytest.raises(ValueError, match="at least one"):
        store.expire("gold", keep=0)


def test_define_tables(spark, store):
    store.write(contract_rows(spark, 3), "gold", "dim_contract", "v1")
    made = store.define("v2")
    assert ("gold", "dim_contract") not in made and len(made) == len(S.TABLES) - 1
    assert store.read("bronze", "subscribers").schema == S.BRONZE
    assert store.read("gold", "dim_contract").count() == 3
    assert len(store.define("v3", replace=True)) == len(S.TABLES)
    assert store.read("gold", "dim_contract").count() == 0


def test_nothing_committed(store):
    with pytest.raises(FileNotFoundError, match="dim_contract"):
        store.read("gold", "dim_contract")
    with pytest.raises(FileNotFoundError, match="no version"):
        store.gold()


def test_row_id_is_unique_and_repeatable(spark, store):
    store.write(contract_rows(spark, 1000).repartition(4), "gold", "dim_contract", "v1")

    def ids():
        df = store.read("gold", "dim_contract", row_id="_row")
        return sorted((r["contract_sk"], r["_row"]) for r in df.collect())

    first = ids()
    assert len({row for _, row in first}) == 1000 and first == ids()


def test_partitioned_layout_prunes(spark, store):
    fact = spark.range(10).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.FACT
          if f.name not in ("fact_sk", "is_churned")],
        F.col("id").alias("fact_sk"), (F.col("id") % 2 == 0).alias("is_churned"),
    )
    store.write(fact, "gold", "fact_customer_churn", "v1", partition_by=["is_churned"])
    df = store.read("gold", "fact_customer_churn")
    assert df.columns == S.FACT.names
    churned = df.where("is_churned")
    assert churned.count() == 5
    plan = churned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_churned" in plan


def test_snapshot_needs_a_shared_version(spark, store):
    store.write(contract_rows(spark, 1), "gold", "dim_contract", "v1")
    store.reset("gold", "dim_service", "v1")
    store.write(contract_rows(spark, 2), "gold", "dim_contract", "v2")
    snapshot = store.snapshot("gold", ["dim_contract", "dim_service"])
    assert snapshot["dim_contract"].count() == 1


def test_register_for_sql(spark, store):
    for rows, version in ((1, "v1"), (2, "v2")):
        store.write(contract_rows(spark, rows), "gold", "dim_contract", version)
        store.register("gold", ["dim_contract"])
        assert spark.sql("SELECT count(*) FROM gold.dim_contract").first()[0] == rows
    spark.sql("DROP TABLE gold.dim_contract")
    assert store.read("gold", "dim_contract").count() == 2


# --- staging -----------------------------------------------------------------------------------

def test_staging_lives_in_the_shared_folder_and_is_removed(spark):
    with Staging(spark) as staging:
        table = staging.table(spark.range(3))
        assert staging.path.startswith(spark.conf.get("spark.checkpoint.dir"))
        assert table.count() == 3
    with pytest.raises(PySparkException):
        spark.read.parquet(staging.path).count()


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


# --- relational tables: options only, no database is started ---------------------------------------

CONNECTION = {"url": "jdbc:some:db", "user": "u", "password": "p"}


def test_jdbc_read_options():
    plain = jdbc.read_options(CONNECTION, "bronze.subscribers")
    assert plain == CONNECTION | {"dbtable": "bronze.subscribers", "fetchsize": "10000"}
    split = jdbc.KeySplit("customerid", 0, 1000, 16)
    parts = jdbc.read_options(CONNECTION, "t", split)
    assert parts["partitionColumn"] == "customerid" and parts["numPartitions"] == "16"
    assert (parts["lowerBound"], parts["upperBound"]) == ("0", "1000")
    with pytest.raises(ValueError, match="parts"):
        jdbc.read_options(CONNECTION, "t", jdbc.KeySplit("c", 0, 1, 0))


def test_jdbc_write_options():
    options = jdbc.write_options(CONNECTION, "gold.fact", connections=8)
    assert options["truncate"] == "true" and options["batchsize"] == "1000"
    assert options["numPartitions"] == "8"
    with pytest.raises(ValueError, match="url"):
        jdbc.write_options({}, "gold.fact")


class Recorder:
    """Stands in for a DataFrameReader or -Writer and remembers what it was asked."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = kwargs or args
            return self
        return call


def test_jdbc_reader_and_writer_are_asked_for_the_options(spark):
    class Session:
        read = Recorder()

    jdbc.read_table(Session(), CONNECTION, "t", jdbc.KeySplit("id", 1, 9, 2))
    calls = Session.read.calls
    assert calls["format"] == ("jdbc",) and "load" in calls
    assert calls["options"]["dbtable"] == "t" and calls["options"]["numPartitions"] == "2"

    class Frame:
        write = Recorder()

        def limit(self, n):
            assert n == 0
            return self

    jdbc.write_table(Frame(), CONNECTION, "t", mode="append", batch_rows=50)
    assert Frame.write.calls["mode"] == ("append",) and "save" in Frame.write.calls
    assert Frame.write.calls["options"]["batchsize"] == "50"
    jdbc.reset_table(Frame(), CONNECTION, "t")
    assert Frame.write.calls["mode"] == ("overwrite",)
    assert Frame.write.calls["options"]["truncate"] == "true"


@pytest.mark.parametrize("text,whole,money", [
    ("1.5e3", 1500, "1500.00"), ("2e-1", None, "0.20"), ("5E+2", 500, "500.00"), ("-1.50e1", -15, "-15.00"),
    ("1.25e0", None, "1.25"), ("1.255e0", None, None), ("1.255e1", None, "12.55"), ("20e-1", 2, "2.00"),
    ("100e-5", None, None), ("0e-9", 0, "0.00"), (".5e1", 5, "5.00"), ("5.e1", 50, "50.00"), ("1e9", 10**9, None),
    ("1e99", None, None), ("e5", None, None), (".e5", None, None), ("1e", None, None), ("1.5e3x", None, None),
])
def test_numbers_with_exponents(spark, text, whole, money):
    df = spark.createDataFrame([(text, text)], "w string, m string")
    types = {"w": T.IntegerType(), "m": T.DecimalType(10, 2)}
    row = typed(df, types, on_bad="null").first()
    assert (row["w"], None if row["m"] is None else str(row["m"])) == (whole, money)
