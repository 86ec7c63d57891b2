from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.functions import pseudonymize
from stratalake.operators import keys as K
from stratalake.operators.joins import fits_broadcast, lookup_key
from stratalake.sources.staging import Staging


@pytest.fixture
def staging(spark):
    with Staging(spark) as staged:
        yield staged


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def windowed(df, order_by):
    return df.withColumn("sk", F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_keys_equal_one_window(spark, staging, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ids = spark.range(3000).select(
            F.when(F.col("id") > 3, pseudonymize(F.col("id"))).alias("digest"),
            (F.col("id") % 5).alias("x"),
        ).distinct().orderBy(F.rand(7))
        expected = content(windowed(ids, ["digest", "x"]))
        assert content(K.key_by_hex_prefix(ids, ["digest", "x"], "sk")) == expected
        assert content(K.key_by_range(ids, ["digest", "x"], "sk", staging)) == expected
        assert content(K.key_labels(ids, ["digest", "x"], "sk", staging)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@contextmanager
def configured(spark, settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_range_key_splits_a_key_with_a_third_of_the_rows(spark, staging):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"),
    )
    tagged = df.withColumn("tag", F.xxhash64("row"))
    # Partitions this small would otherwise be merged again.
    with configured(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        keyed = K.key_by_range(tagged, ["k"], "sk", staging, spread_by=["tag"], drop=["tag"])
    assert keyed.columns == ["k", "row", "sk"]
    numbers = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(numbers) == (1, 60_000, 60_000)
    assert keyed.where("k = -1").agg(F.max("sk")).first()[0] == 20_000
    disordered = keyed.withColumn("before", F.lag("k").over(Window.orderBy("sk")))
    assert disordered.where("before > k").count() == 0
    staged = spark.read.parquet(f"{staging.path}/*")
    sizes = [r["count"] for r in staged.groupBy(F.shiftright("_slot", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 60_000 / 8 * 1.5


def test_range_key_of_equal_rows_and_empty_table(spark, staging):
    same = spark.range(1000).select(F.lit(1).alias("k"))
    assert content(K.key_by_range(same, ["k"], "sk", staging)) == [(1, i) for i in sorted(
        range(1, 1001), key=repr)]
    assert K.key_by_range(same.limit(0), ["k"], "sk", staging).count() == 0


def test_large_label_table_is_not_numbered_in_one_task(spark, staging, monkeypatch):
    monkeypatch.setattr(K, "fits_broadcast", lambda df: False)
    df = spark.range(500).select(F.col("id").alias("k"))
    keyed = K.key_labels(df, ["k"], "sk", staging)
    assert "_slot" in plan_of(keyed)
    assert content(keyed) == content(windowed(df, ["k"]))


def test_only_offsets_meet_in_one_task(spark, staging):
    df = spark.range(1000).select(pseudonymize(F.col("id")).alias("digest"))
    for keyed in (
        K.key_by_hex_prefix(df, ["digest"], "sk"),
        K.key_by_range(df, ["digest"], "sk", staging),
    ):
        lines = plan_of(keyed).splitlines()
        single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
        assert len(single) == 1
        assert "HashAggregate" in lines[single[0] + 1] and "count" in lines[single[0] + 1]


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame(
        [("a", None, 1), ("a", None, 2), ("b", "y", 3), ("z", "y", 4)], "k string, l string, v int"
    )
    dim = spark.createDataFrame(
        [("a", None, 10), ("b", "y", 20)], "k string, l string, sk long"
    )
    return fact, dim


@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_null_keys(star, broadcast):
    fact, dim = star
    plain = lookup_key(fact, dim, ["k", "l"], "sk", broadcast=broadcast)
    assert content(plain) == [("b", "y", 3, 20)]
    safe = lookup_key(fact, dim, ["k", "l"], "sk", null_safe=True, broadcast=broadcast)
    assert safe.columns == ["k", "l", "v", "sk"]
    assert content(safe) == [("a", None, 1, 10), ("a", None, 2, 10), ("b", "y", 3, 20)]


def test_lookup_conflicts(spark):
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, age int")
    dim = rows.withColumn("sk", F.col("age").cast("bigint"))
    assert lookup_key(rows, dim, ["k"], "sk").count() == 5
    picked = lookup_key(rows, dim, ["k"], "sk", on_conflict="pick", prefer=F.col("age"))
    assert content(picked) == [("x", 1, 2), ("x", 2, 2), ("y", 3, 3)]
    with pytest.raises(PySparkException, match="several sk"):
        lookup_key(rows, dim, ["k"], "sk", on_conflict="error").count()
    unique = dim.where("sk <> 2")
    assert lookup_key(rows, unique, ["k"], "sk", on_conflict="error").count() == 3
    with pytest.raises(ValueError, match="prefer"):
        lookup_key(rows, dim, ["k"], "sk", on_conflict="pick")
    with pytest.raises(ValueError, match="on_conflict"):
        lookup_key(rows, dim, ["k"], "sk", on_conflict="?")


def test_fits_broadcast(spark):
    df = spark.range(50).select(F.lit("x" * 100).alias("t"), F.lit(None).cast("int").alias("n"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=49)
    assert not fits_broadcast(df, max_bytes=4000)
    assert fits_broadcast(df.limit(0))


@pytest.mark.parametrize("on_conflict", ["fanout", "error", "pick"])
def test_hot_key_is_split_in_the_customer_join(spark, staging, on_conflict):
    """A shuffled lookup whose key holds a third of the rows runs as a skew join."""
    small_numbers = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    with configured(spark, small_numbers):
        fact = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dim = staging.table(fact.select("k", F.col("k").alias("sk")).distinct())
        joined = lookup_key(
            fact, dim, ["k"], "sk", on_conflict=on_conflict,
            prefer=F.col("sk") if on_conflict == "pick" else None, staging=staging,
        )
        assert len(joined.collect()) == 60_000
        assert "isSkew=true" in plan_of(joined) or "skewed" in plan_of(joined)
