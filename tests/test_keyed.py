"""Keyed changes made in place."""

import pytest
from pyspark.sql import functions as F

from sheafline.operators import keyed


def files(tmp_path):
    return {str(f.relative_to(tmp_path / "t")) for f in (tmp_path / "t").rglob("*.parquet")}


def folders(names):
    return {n.split("/")[0] for n in names}


@pytest.fixture
def table(spark, tmp_path):
    made = keyed.KeyedTable(str(tmp_path / "t"), buckets=8)
    rows = spark.range(40).select("id", F.lit("old").alias("note"), F.lit(1).cast("bigint").alias("status"))
    keyed.write_keyed(rows.unionByName(spark.createDataFrame([(None, "no id", 1)], "id bigint, note string, status bigint")), made)
    return made


def state(spark, table):
    rows = keyed.read_keyed(spark, table).collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: (r.note, r.status) for r in rows}


def hit(spark, table, ids):
    keys = spark.createDataFrame([(i,) for i in ids], "id bigint")
    return {f"key_bucket={r[0]}" for r in keys.select(table.bucket()).collect()}


def test_only_the_folders_hit_are_written(spark, table, tmp_path):
    before, files_before = state(spark, table), files(tmp_path)
    updates = spark.createDataFrame([(3, None), (4, "new"), (99, "nobody")], "id bigint, note string")
    assert keyed.run_merge(spark, table, updates, ["note"], "one") == 2
    after, files_after = state(spark, table), files(tmp_path)
    assert after == before | {3: (None, 1), 4: ("new", 1)}
    touched = hit(spark, table, [3, 4, 99])
    assert len(touched) < 8 and folders(files_before ^ files_after) == touched
    # The same change again: nothing is written.
    assert keyed.run_merge(spark, table, updates, ["note"], "one") == 2
    assert files(tmp_path) == files_after


def test_read_of_some_folders_is_pruned(spark, table):
    plan = keyed.read_keyed(spark, table, [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan


def test_status_and_delete_with_repeated_and_unknown_keys(spark, table, tmp_path):
    ids = spark.createDataFrame([(5,), (5,), (77,), (None,)], "id bigint")
    assert keyed.run_status(spark, table, ids, "status", 3, "s") == 1
    assert {i for i, (_, s) in state(spark, table).items() if s == 3} == {5}
    assert keyed.run_delete(spark, table, ids, "d") == 1
    assert set(state(spark, table)) == {None, *range(40)} - {5}


def test_a_folder_may_lose_all_its_rows(spark, table, tmp_path):
    bucket = keyed.read_keyed(spark, table).select("id", table.bucket().alias("b")).collect()
    gone = [r.id for r in bucket if r.b == 2 and r.id is not None]
    assert gone
    assert keyed.run_delete(spark, table, spark.createDataFrame([(i,) for i in gone], "id bigint"), "empty") == len(gone)
    assert set(state(spark, table)) == {None, *range(40)} - set(gone)
    updates = spark.createDataFrame([(i, "back") for i in gone], "id bigint, note string")
    assert keyed.run_merge(spark, table, updates, ["note"], "after") == 0


def test_a_change_that_stopped_half_way_is_finished(spark, table, tmp_path, monkeypatch):
    before = state(spark, table)
    gone = spark.createDataFrame([(1,), (2,)], "id bigint")

    def stop(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(keyed, "_place", stop)
        with pytest.raises(RuntimeError):
            keyed.run_delete(spark, table, gone, "late")
    assert state(spark, table) == before
    # Half of the new folders are in place and the old ones are gone.
    for folder in hit(spark, table, [1]):
        for file in (tmp_path / "t" / folder).glob("*.parquet"):
            file.unlink()
    assert keyed.run_delete(spark, table, gone, "late") == 2
    assert set(state(spark, table)) == set(before) - {1, 2}


def test_repeated_keys_need_an_order(spark, table):
    updates = spark.createDataFrame([(3, "b"), (3, "a")], "id bigint, note string")
    with pytest.raises(Exception, match="repeated key"):
        keyed.run_merge(spark, table, updates, ["note"], "x")
    assert keyed.run_merge(spark, table, updates, ["note"], "y", order=[F.col("note").asc()]) == 1
    assert state(spark, table)[3] == ("a", 1)
