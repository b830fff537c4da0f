"""All-or-nothing publish: what readers see around failed, partial and concurrent writes."""

import os

import pytest
from pyspark.sql import functions as F

from quartermart.sources import sinks, versions

SCHEMA = "k string, y int, q int"
ROWS = [("a", 2020, 1), ("b", 2020, 2), ("c", 2021, 1)]


def rows(df):
    return sorted(map(tuple, df.collect()))


def failing(df):
    """Raises in the middle of the job."""
    return df.withColumn("k", F.when(F.col("y") == 2021, F.raise_error(F.lit("broken"))).otherwise(F.col("k")))


@pytest.mark.parametrize("root", [True, False])
@pytest.mark.parametrize("by", [(), ("y", "q")])
def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, root, by):
    where = str(tmp_path) if root else None
    name = f"dws.t_fail_{len(by)}"
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.overwrite_table(df, name, partition_by=by, root=where)
    with pytest.raises(Exception, match="broken"):
        sinks.overwrite_table(failing(df.withColumn("k", F.lit("new"))), name, partition_by=by, root=where)
    assert rows(sinks.read_table(spark, name, where)) == ROWS
    if not root:
        assert rows(spark.table(name).select("k", "y", "q")) == ROWS
    sinks.overwrite_table(df.where("k = 'a'"), name, partition_by=by, root=where)
    assert rows(sinks.read_table(spark, name, where)) == ROWS[:1]
    if root:  # nothing of the failed write or the old version is left
        folder = tmp_path / "dws" / name.split(".")[1]
        assert len([f for f in os.listdir(folder) if f.startswith("version=")]) == 1
        assert rows(spark.read.parquet(str(folder)).select("k", "y", "q")) == ROWS[:1]


def test_partial_replacement_keeps_other_files(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    first = versions.publish(df, at, ["y", "q"])
    kept = first.places["y=2020/q=2"][0]
    files = sorted(os.listdir(tmp_path / "t" / kept / "y=2020" / "q=2"))
    versions.publish(df.where("k = 'a'").withColumn("k", F.lit("z")), at, ["y", "q"], replace=[(2020, 1), (2021, 1)])
    assert rows(versions.read(spark, at)) == [("b", 2020, 2), ("z", 2020, 1)]
    assert sorted(os.listdir(tmp_path / "t" / kept / "y=2020" / "q=2")) == files
    with pytest.raises(ValueError, match="outside"):
        versions.publish(df, at, ["y", "q"], replace=[(2020, 1)])
    assert rows(versions.read(spark, at)) == [("b", 2020, 2), ("z", 2020, 1)]


def test_partial_replacement_in_the_catalog(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.overwrite_table(df, "dws.t_parts", partition_by=["y", "q"])
    sinks.overwrite_table(df.where("k = 'b'").withColumn("k", F.lit("it's")), "dws.t_parts", partition_by=["y", "q"], replace=[(2020, 2)])
    want = [("a", 2020, 1), ("c", 2021, 1), ("it's", 2020, 2)]
    assert rows(spark.sql("SELECT k, y, q FROM dws.t_parts")) == want == rows(sinks.read_table(spark, "dws.t_parts"))


def test_the_slower_of_two_writers_raises(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    versions.publish(df, at)
    put = versions.Store.put

    def late(self, name, text):  # another writer commits first
        monkeypatch.setattr(versions.Store, "put", put)
        versions.publish(df.where("k = 'b'"), at)
        return put(self, name, text)

    monkeypatch.setattr(versions.Store, "put", late)
    with pytest.raises(versions.ConcurrentWrite):
        versions.publish(df.where("k = 'c'"), at)
    assert rows(versions.read(spark, at)) == [ROWS[1]]


def test_earlier_commits_stay_for_readers_at_work(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    versions.publish(df, at)
    at_work = versions.read(spark, at)
    versions.publish(df.where("k = 'b'"), at, keep=1)
    assert rows(at_work) == ROWS and rows(versions.read(spark, at, number=1)) == ROWS
    assert rows(versions.read(spark, at)) == [ROWS[1]]
    versions.publish(df.where("k = 'c'"), at, keep=1)
    with pytest.raises(ValueError, match="no commit 1"):
        versions.read(spark, at, number=1)


def test_empty_tables_keep_their_schema_and_old_folders_are_taken_over(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.partitionBy("y", "q").parquet(at)      # a folder without commits
    assert rows(versions.read(spark, at).select("k", "y", "q")) == ROWS
    versions.publish(df.where("1 = 0"), at, ["y", "q"])
    back = versions.read(spark, at)
    assert back.columns == ["k", "y", "q"] and back.count() == 0


def test_append_adds_rows_and_keeps_files(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError, match="yet"):
        versions.publish(df, at, ["y", "q"], append=True)
    versions.publish(df, at, ["y", "q"])
    versions.publish(df.where("k = 'a'"), at, ["y", "q"], append=True)
    assert rows(versions.read(spark, at)) == sorted([*ROWS, ROWS[0]])
    versions.publish(df.where("k = 'a'"), at, ["y", "q"], replace=[(2020, 1)])
    assert rows(versions.read(spark, at)) == ROWS
    sinks.overwrite_table(df, "dws.t_app")
    with pytest.raises(ValueError, match="root path"):
        sinks.overwrite_table(df, "dws.t_app", append=True)
