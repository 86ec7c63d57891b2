"""The swap of gold in a database, on recorded calls: no database is started."""

from __future__ import annotations

import re

import pytest

from stratalake.job import parse, run
from stratalake.operators.checks import ConstraintViolation
from stratalake.schemas import GOLD_TABLES, TABLES
from stratalake.sources import jdbc
from stratalake.sources.shadow import ShadowStore
from stratalake.workload.queries import _csv_folder

GOLD = [f"gold.{t}" for t in GOLD_TABLES]
DATABASE = ["--jdbc-url", "jdbc:test", "--jdbc-option", "user=me", "--jdbc-swap"]


class Database:
    """Keeps tables by name; a list of statements takes effect as a whole or not at all."""

    def __init__(self):
        self.tables = {f"gold.{t}": ([], TABLES["gold", t]) for t in GOLD_TABLES}
        self.log, self.transactions, self.refuse = [], [], None

    def read_table(self, spark, connection, table, split=None):
        rows, schema = self.tables[table]
        return spark.createDataFrame(rows, schema)

    def write_table(self, df, connection, table, mode="overwrite", **options):
        rows = df.collect()
        if self.refuse and re.search(self.refuse, table):
            raise OSError(f"no room for {table}")
        self.tables[table] = rows, df.schema
        self.log.append((table, len(rows)))

    def reset_table(self, df, connection, table):
        self.write_table(df.limit(0), connection, table)

    def execute(self, spark, connection, statements):
        assert connection == {"url": "jdbc:test", "user": "me"}
        self.transactions.append(list(statements))
        after = dict(self.tables)
        for s in statements:
            if self.refuse and re.search(self.refuse, s):
                raise OSError(s)
            if m := re.fullmatch(r"CREATE TABLE (\S+) \(LIKE (\S+) INCLUDING ALL\)", s):
                assert m[1] not in after
                after[m[1]] = [], after[m[2]][1]
            elif m := re.fullmatch(r"ALTER TABLE (\S+) RENAME TO (\S+)", s):
                assert f"gold.{m[2]}" not in after
                after[f"gold.{m[2]}"] = after.pop(m[1])
            elif m := re.fullmatch(r"DROP TABLE IF EXISTS (\S+)", s):
                after.pop(m[1], None)
            else:
                m = re.fullmatch(r"ALTER TABLE (\S+) ADD FOREIGN KEY \((\w+)\) REFERENCES (\S+) \((\w+)\)", s)
                keys = {r[m[4]] for r in after[m[3]][0]}
                if not {r[m[2]] for r in after[m[1]][0]} <= keys:
                    raise OSError(s)
        self.tables = after

    def gold(self):
        return {t: sorted(map(str, self.tables[t][0])) for t in GOLD}


@pytest.fixture
def database(monkeypatch):
    made = Database()
    for name in ("read_table", "write_table", "reset_table", "execute"):
        monkeypatch.setattr(jdbc, name, getattr(made, name))
    return made


@pytest.fixture(scope="module")
def source(spark):
    return _csv_folder(spark, "/root/testdata/sf0.001")


def stages(spark, source, *names, run_id="r1"):
    for name in names:
        run(spark, parse([name, "--source", source, "--run-id", run_id, *DATABASE]))


def test_all_four_tables_change_in_one_transaction(spark, source, database, tmp_path):
    stages(spark, source, "bronze", "silver", "gold")
    assert [t for t, _ in database.log] == [
        "bronze.subscribers", "silver.subscribers", *(f"gold.{t}__next" for t in GOLD_TABLES),
    ]
    create, swap = database.transactions
    assert [s.split()[0] for s in create] == ["DROP"] * 4 + ["CREATE"] * 4
    assert sum("REFERENCES" in s for s in swap) == 3 and sum("RENAME" in s for s in swap) == 8
    assert sorted(database.tables) == sorted([
        "bronze.subscribers", "silver.subscribers", *GOLD, *(f"{t}__previous" for t in GOLD),
    ])
    report = list(run(spark, parse(["report", *DATABASE])))
    list(run(spark, parse(["all", "--store", str(tmp_path), "--source", source, "--run-id", "r1"])))
    assert report == list(run(spark, parse(["report", "--store", str(tmp_path)])))
    # The next refresh replaces what the last one set aside.
    before = database.gold()
    stages(spark, source, "gold", run_id="r2")
    assert all(len(before[t]) == len(database.gold()[t]) for t in GOLD)
    assert sorted(map(str, database.tables[f"{GOLD[0]}__previous"][0])) == before[GOLD[0]]


def test_a_failed_check_leaves_fact_and_dimensions_untouched(spark, source, database):
    stages(spark, source, "bronze", "silver", "gold")
    before = database.gold()
    database.tables["silver.subscribers"] = [], database.tables["silver.subscribers"][1]
    with pytest.raises(ConstraintViolation):
        stages(spark, source, "gold", run_id="r2")
    assert database.gold() == before and all(before.values())
    assert not any(t.endswith("__next") for t in database.tables)


@pytest.mark.parametrize("refuse", ["fact_customer_churn__next$", "dim_service__next$", "FOREIGN KEY", "fact_customer_churn RENAME"])
def test_a_refresh_that_breaks_off_leaves_gold_untouched(spark, source, database, refuse):
    stages(spark, source, "bronze", "silver", "gold")
    before = database.gold()
    database.refuse = refuse
    with pytest.raises(OSError):
        stages(spark, source, "gold", run_id="r2")
    assert database.gold() == before
    # What it left behind does not disturb the next one.
    database.refuse = None
    stages(spark, source, "gold", run_id="r3")
    assert not any(t.endswith("__next") for t in database.tables)


def test_unpublish_goes_back_to_the_tables_replaced(spark, database):
    database.tables |= {f"{t}__previous": (["old"], None) for t in GOLD}
    store = ShadowStore(spark, {"url": "jdbc:test", "user": "me"})
    store.unpublish("gold", "fact_customer_churn", "v")
    assert all(database.tables[t][0] == ["old"] for t in GOLD)
    assert all(database.tables[f"{t}__next"][0] == [] for t in GOLD)


class Connection:
    def __init__(self, fails_at=None):
        self.log, self.fails_at = [], fails_at

    def setAutoCommit(self, on):
        self.log.append(("auto", on))

    def createStatement(self):
        return self

    def execute(self, text):
        if text == self.fails_at:
            raise OSError(text)
        self.log.append(text)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_statements_are_one_transaction():
    fine, broken = Connection(), Connection("b")
    jdbc.run_all(fine, ["a", "b"])
    assert fine.log == [("auto", False), "a", "b", "commit", "close"]
    with pytest.raises(OSError):
        jdbc.run_all(broken, ["a", "b", "c"])
    assert broken.log == [("auto", False), "a", "rollback", "close"]


def test_arguments(spark):
    with pytest.raises(SystemExit):
        parse(["report", "--store", "/s", "--jdbc-swap"])
