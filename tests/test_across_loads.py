"""Ledger, key registry, rank state and customer history over several loads."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.operators.ledger import RowLedger
from stratalake.operators.rank_state import RankState
from stratalake.operators.registry import KeyRegistry
from stratalake.plans.history import SPAN, as_of, next_history, one_per_customer
from stratalake.sources.filesystem import remove_tree
from stratalake.sources.staging import Staging

SCHEMA = "a int, b string, c double, d decimal(10,2)"


@pytest.fixture
def staging(spark):
    with Staging(spark) as made:
        yield made


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- ledger ------------------------------------------------------------------------------------

def random_rows(rng, n):
    return [
        (rng.choice([None, 1, 2]), rng.choice([None, "", "x", "x\",\"b", "null"]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]),
         rng.choice([None, Decimal("1.00")]))
        for _ in range(n)
    ]


def test_loads_together_equal_one_dedupe(spark, staging):
    rng = random.Random(1)
    loads = [spark.createDataFrame(random_rows(rng, n), SCHEMA) for n in (40, 0, 120, 60)]
    ledger = RowLedger(spark, staging.folder(), buckets=4)
    accepted = [ledger.accept(df, f"l{i}", staging) for i, df in enumerate(loads)]
    whole = loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[3])
    union = accepted[0]
    for more in accepted[1:]:
        union = union.unionByName(more)
    assert union.count() == union.distinct().count() == whole.distinct().count()
    assert union.exceptAll(whole.distinct()).count() == 0
    assert accepted[1].count() == 0 and ledger.loads() == ["l0", "l1", "l2", "l3"]
    # As one load, the ledger still knows every row.
    ledger.compact("m0")
    assert ledger.loads() == ["m0"]
    assert ledger.accept(whole, "n0", staging).count() == 0


def test_a_row_with_a_third_of_a_load(spark, staging):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("a"))
    ledger = RowLedger(spark, staging.folder(), buckets=4)
    first = ledger.accept(rows, "l0", staging, copies="n")
    assert first.where("a = 0").first()["n"] == 1000 and first.count() == 2001
    assert ledger.accept(rows.unionByName(spark.range(-5, 0).toDF("a")), "l1", staging).count() == 5


def test_the_ledger_is_not_shuffled(spark, staging):
    ledger = RowLedger(spark, staging.folder(), buckets=4)
    ledger.accept(spark.range(500).toDF("a"), "l0", staging)
    load = spark.range(600).select(F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("_digest"))
    joined = load.repartition(4, "_digest").join(ledger.seen()[0].hint("merge"), "_digest", "left_anti")
    plan = plan_of(joined).split("== Physical Plan ==")[-1]
    right = plan[plan.index("LocationPath") if "LocationPath" in plan else plan.rindex("FileScan") :]
    assert plan.count("Exchange") == 1 and "Bucketed: true" in right


def test_an_unfinished_load_is_repeated_and_a_finished_one_refused(spark, staging):
    folder = staging.folder()
    ledger = RowLedger(spark, folder, buckets=2)
    ledger.accept(spark.range(10).toDF("a"), "l0", staging)
    ledger.accept(spark.range(20).toDF("a"), "l1", staging)
    remove_tree(spark, f"{folder}/l1/_DONE")
    assert RowLedger(spark, folder, buckets=2).accept(spark.range(30).toDF("a"), "l1", staging).count() == 20
    with pytest.raises(ValueError, match="already"):
        ledger.accept(spark.range(1).toDF("a"), "l0", staging)


def test_columns_left_out_of_the_comparison(spark, staging):
    ledger = RowLedger(spark, staging.folder(), buckets=2)
    first = spark.createDataFrame([(1, "f2"), (1, "f1"), (2, "f1")], "a int, file string")
    assert sorted(map(tuple, ledger.accept(first, "l0", staging, keep_min=["file"]).collect())) == [(1, "f1"), (2, "f1")]
    again = spark.createDataFrame([(1, "f9"), (3, "f9")], "a int, file string")
    assert list(map(tuple, ledger.accept(again, "l1", staging, keep_min=["file"]).collect())) == [(3, "f9")]


# --- registry ----------------------------------------------------------------------------------

def test_old_keys_stay_and_new_ones_go_on(spark, staging):
    folder = staging.folder()
    keys = spark.createDataFrame([], "k string, m int").schema

    def registry():
        return KeyRegistry(spark, folder, keys, "sk")

    rng, seen = random.Random(2), {}
    for refresh in range(4):
        rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2])) for _ in range(15 * (refresh != 2))]
        added = registry().add(spark.createDataFrame([(*r, "more") for r in rows], "k string, m int, x string"), f"r{refresh}", staging)
        now = {(r["k"], r["m"]): r["sk"] for r in registry().entries().collect()}
        new = {k: v for k, v in now.items() if k not in seen}
        assert {k: now[k] for k in seen} == seen and added == len(new)
        assert set(now) == set(seen) | set(rows)
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        # In the order of the keys, NULLs first.
        order = sorted(new, key=lambda k: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in k))
        assert [new[k] for k in order] == sorted(new.values())
        seen = now
    known = registry().numbered(spark.createDataFrame([(*next(iter(seen)), 5), ("zz", 1, 6)], "k string, m int, y int"))
    assert {r["y"]: r["sk"] for r in known.collect()} == {5: next(iter(seen.values())), 6: None}
    with pytest.raises(ValueError, match="already"):
        registry().add(spark.createDataFrame([], "k string, m int"), "r1", staging)


def test_a_hot_key_is_one_entry(spark, staging):
    registry = KeyRegistry(spark, staging.folder(), spark.createDataFrame([], "k long").schema, "sk")
    hot = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k"))
    assert registry.add(hot, "r0", staging) == 1001
    assert registry.numbered(hot).groupBy("sk").count().agg(F.max("count")).first()[0] == 4000


# --- rank state --------------------------------------------------------------------------------

def test_medians_of_added_histograms(spark, staging):
    rng = random.Random(3)
    schema = "i int, l long, d decimal(18,4), f double"

    def load(n):
        return [
            tuple(None if rng.random() < 0.2 else make() for make in (
                lambda: rng.randrange(-9, 9), lambda: rng.randrange(-10**17, 10**17),
                lambda: Decimal(rng.randrange(-10**12, 10**12)).scaleb(-4), lambda: rng.gauss(0, 1e9),
            )) for _ in range(n)
        ]

    rows = [load(n) for n in (31, 0, 500, 8)]
    tables = [staging.table(spark.createDataFrame(r, schema)) for r in rows]
    state = RankState(spark, staging.folder(), tables[0].schema)
    for i, df in enumerate(tables):
        state.add(df, f"l{i}")
        got = {r["column_name"]: r["median"] for r in state.medians(tables[: i + 1]).collect()}
        for c, name in enumerate("ildf"):
            values = [r[c] for own in rows[: i + 1] for r in own if r[c] is not None]
            assert got[name] == pytest.approx(float(statistics.median(values)), rel=1e-15)
    with pytest.raises(ValueError, match="already"):
        state.add(tables[0], "l0")
    with pytest.raises(ValueError, match="18 digits"):
        RankState(spark, "/nowhere", spark.createDataFrame([], "x decimal(30,2)").schema)


def scans(df):
    """Parquet scans of the plan as Spark would run it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "FileScan parquet" in line]


def test_only_the_sought_bucket_is_read_again(spark, staging):
    df = staging.table(spark.range(2000).select(
        (F.col("id") % 97).cast("int").alias("a"), (F.col("id") * 10**9).alias("b"),
        (F.col("id") * 1.5e7).alias("c"), (F.col("id") * 10**6).cast("decimal(14,2)").alias("d"),
    ))
    state = RankState(spark, staging.folder(), df.select("a").schema)
    state.add(df, "l0")
    medians = state.medians([df])
    assert medians.first()["median"] == statistics.median(i % 97 for i in range(2000))
    # Everyday numbers are settled by the histogram: no rows are read.
    assert scans(medians) == []
    wide = RankState(spark, staging.folder(), df.schema)
    wide.add(df, "l0")
    medians = wide.medians([df])
    assert {r["column_name"]: r["median"] for r in medians.collect()} == {
        "a": statistics.median(i % 97 for i in range(2000)),
        "b": 999.5e9, "c": 999.5 * 1.5e7, "d": 999.5e6,
    }
    again = scans(medians)
    assert again
    for line in again:
        assert "struct<b:bigint,c:double,d:decimal(14,2)>" in line and "LessThanOrEqual(b," in line


def test_no_loads_no_medians(spark, staging):
    state = RankState(spark, staging.folder(), spark.createDataFrame([], "a int").schema)
    assert state.medians([]).count() == 0


# --- history -----------------------------------------------------------------------------------

def day(n):
    return datetime(2024, 1, n, tzinfo=timezone.utc)


def at(n):
    return F.timestamp_micros(F.lit(int(day(n).timestamp() * 1e6)))


def test_history_against_plain_loops(spark, staging):
    rng = random.Random(4)
    history, expected = None, []
    snapshots = []
    for n in range(1, 6):
        now = {k: (rng.choice([None, 1, 2]), rng.choice([None, "x"])) for k in "abcdefghij" if rng.random() < 0.7 and n != 4}
        snapshots.append(now)
        for row in expected:
            if row[4] is None and now.get(row[0]) != tuple(row[1:3]):
                row[4] = n
        still = {row[0] for row in expected if row[4] is None}
        expected += [[k, *v, n, None] for k, v in now.items() if k not in still]
        table = staging.table(spark.createDataFrame([(k, *v) for k, v in now.items()], "k string, v int, w string"))
        history = staging.table(next_history(history, table, "k", ["v", "w"], at(n)))
        assert history.columns == ["k", "v", "w", *SPAN]
        got = [
            (r["k"], r["v"], r["w"], r["s"], r["e"])
            for r in history.withColumns({"s": F.dayofmonth("effective_date"), "e": F.dayofmonth("end_date")}).collect()
        ]
        assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in expected)
        assert history.where(F.col("is_current") != F.col("end_date").isNull()).count() == 0
    for n, now in enumerate(snapshots, 1):
        assert {r["k"]: (r["v"], r["w"]) for r in as_of(history, at(n)).collect()} == now


def test_missing_values_in_different_places_differ(spark, staging):
    first = staging.table(spark.createDataFrame([("a", None, 1), ("b", 1, 1)], "k string, v int, w int"))
    second = staging.table(spark.createDataFrame([("a", 1, None), ("b", 1, 1)], "k string, v int, w int"))
    history = staging.table(next_history(None, first, "k", ["v", "w"], at(1)))
    rows = next_history(history, second, "k", ["v", "w"], at(2)).collect()
    assert sorted((r["k"], r["is_current"]) for r in rows) == [("a", False), ("a", True), ("b", True)]


def test_one_row_per_customer(spark):
    rows = spark.createDataFrame(
        [("a", 5, "x"), ("a", 9, None), ("a", 9, "y"), ("b", None, "z"), (None, 1, "q")], "k string, tenure int, w string"
    )
    got = {r["k"]: (r["tenure"], r["w"]) for r in one_per_customer(rows, "k", ["tenure", "w"], ["tenure"]).collect()}
    assert got == {"a": (9, "y"), "b": (None, "z")}
