from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from stratalake.context import RunContext
from stratalake.plans.bronze import build_bronze
from stratalake.streaming import manifest as M
from stratalake.streaming.refresh import refresh_silver
from stratalake.workload.subscribers import subscriber_raw

CTX = RunContext(run_id="test")


@pytest.fixture
def opened(monkeypatch):
    """Names of the files whose footer was read."""
    seen, read = [], M.read_footer

    def footer(spark, path):
        seen.append(path.rsplit("/", 1)[-1])
        return read(spark, path)

    monkeypatch.setattr(M, "read_footer", footer)
    return seen


def add(spark, folder, name, rows, columns="id long, v string"):
    """One Parquet file of a given name."""
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(f"{folder}-made")
    (made,) = folder.parent.joinpath(f"{folder.name}-made").glob("part-*.parquet")
    folder.mkdir(exist_ok=True)
    shutil.move(made, folder / f"{name}.parquet")


def test_each_file_is_opened_once(spark, tmp_path, opened):
    folder, manifest = tmp_path / "in", M.FileManifest(spark, str(tmp_path / "manifest"))
    add(spark, folder, "a", [(1, "x")])
    add(spark, folder, "b", [(2, "y")])
    schema = manifest.check(str(folder))
    assert sorted(opened) == ["a.parquet", "b.parquet"] and schema.names == ["id", "v"]
    add(spark, folder, "c", [(3, None)])
    assert manifest.check(str(folder)) == schema
    assert opened[2:] == ["c.parquet"]
    assert manifest.check(str(folder)) == schema and len(opened) == 3
    rows = manifest.files().collect()
    assert len(rows) == 3 and {r["fingerprint"] for r in rows} == {M.fingerprint(schema)}


def test_a_replaced_file_is_new_and_a_refused_one_is_not_remembered(spark, tmp_path, opened):
    folder, manifest = tmp_path / "in", M.FileManifest(spark, str(tmp_path / "manifest"))
    add(spark, folder, "a", [(1, "x")])
    manifest.check(str(folder))
    (folder / "a.parquet").unlink()
    add(spark, folder, "a", [(i, str(i)) for i in range(500)])
    manifest.check(str(folder))
    assert opened == ["a.parquet"] * 2
    for columns, rows in (("id long, v string, w int", [(1, "x", 2)]), ("id long", [(1,)]), ("id int, v string", [(1, "x")])):
        add(spark, folder, "z", rows, columns)
        for _ in range(2):
            with pytest.raises(M.SchemaDrift, match="z.parquet"):
                manifest.check(str(folder))
        (folder / "z.parquet").unlink()
    assert opened[2:] == ["z.parquet"] * 6
    # The order of columns does not matter.
    add(spark, folder, "b", [("x", 1)], "v string, id long")
    assert manifest.check(str(folder)).names == ["id", "v"]


def test_many_refreshes_leave_few_parts(spark, tmp_path, opened, monkeypatch):
    monkeypatch.setattr(M, "_MOST_PARTS", 2)
    monkeypatch.setattr(M, "_BATCH", 1)
    folder, manifest = tmp_path / "in", M.FileManifest(spark, str(tmp_path / "manifest"))
    for name in "abcde":
        add(spark, folder, name, [(1, name)])
        manifest.check(str(folder))
        assert len(manifest._parts()) <= 2
    assert sorted(opened) == [f"{n}.parquet" for n in "abcde"] and manifest.files().count() == 5


def test_an_empty_folder_has_no_schema(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert M.FileManifest(spark, str(tmp_path / "manifest")).check(str(tmp_path / "in")) is None


def test_second_refresh_opens_new_files_only(spark, tmp_path, opened):
    folder, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    bronze = build_bronze(subscriber_raw(spark, "/root/testdata/sf0.001"), CTX)

    def deliver(part):
        bronze.where(F.col("customerid") % 2 == part).coalesce(1).write.mode("append").parquet(folder)
        refresh_silver(spark, folder, silver, checkpoint, CTX)
        return len(opened), spark.read.parquet(silver).count()

    first, second = deliver(0), deliver(1)
    assert (first[0], second[0]) == (1, 2)
    assert second[1] == bronze.count() > first[1] > 0
    refresh_silver(spark, folder, silver, checkpoint, CTX)
    assert len(opened) == 2 and spark.read.parquet(silver).count() == second[1]
