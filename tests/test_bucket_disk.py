"""What a bucketed write shuffles and leaves on disk; joins with a dimension of bounded size."""

import os
import time

import pytest
from conftest import poi_df, visits_df
from pyspark.sql import functions as F

from quartermart.operators.join import BOUNDED, attach_dim
from quartermart.sources import buckets


def data(spark):
    visits = visits_df(spark, [(f"u{i % 17}", f"201{i % 3}-0{1 + i % 9}-11", "Solo" if i % 2 else "Friends", f"p{i % 4}") for i in range(400)])
    return visits.repartition(5), poi_df(spark, [("p0", "A", "c1", "r1"), ("p1", "B", "c2", "r1"), ("p2", None, None, "r2")])


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.fixture(autouse=True)
def no_tables_left(spark):
    yield
    for t in spark.catalog.listTables("default"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def test_a_bucketed_write_leaves_its_table_alone(spark, tmp_path):
    visits, _ = data(spark)
    confs = lambda: (spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None), spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled"))
    set_before = confs()
    before = shuffle_files(spark)
    buckets.write_bucketed(visits, "d_visits", ["trip_id"], 4, partition_by=["travel_year"], home=str(tmp_path))
    for _ in range(100):  # Spark doesn't wait until they are gone
        left = shuffle_files(spark) - before
        time.sleep(0.1 if left else 0)
    assert not left
    assert [n.startswith(buckets.VERSION) for n in os.listdir(tmp_path)] == [True]
    assert [t.name for t in spark.catalog.listTables("default")] == ["d_visits"]
    assert confs() == set_before
    table = spark.table("d_visits")
    assert table.count() == 400 and table.select(*visits.columns).exceptAll(visits).count() == 0
    assert len(table.inputFiles()) <= 4 * 3


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    visits, _ = data(spark)
    with pytest.raises(Exception, match="broken off"):
        buckets.write_bucketed(visits.withColumn("poi_id", F.when(F.col("poi_id") == "p3", F.raise_error(F.lit("broken off"))).otherwise("x")),
                               "d_broken", ["trip_id"], 4, home=str(tmp_path))
    assert not [n for n in os.listdir(tmp_path) if n.startswith(buckets.LOOSE)] and not spark.catalog.listTables("default")


def test_rows_in_buckets_are_dealt_without_a_shuffle(spark, tmp_path):
    visits, _ = data(spark)
    visits.write.format("parquet").bucketBy(4, "trip_id").option("path", f"{tmp_path}/loose").saveAsTable("d_loose")
    with buckets._buckets_read(spark):
        rows = buckets.dealt(spark.table("d_loose"), ["trip_id"], 4)
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.rdd.getNumPartitions() == 4


def test_a_dimension_of_bounded_size_is_broadcast(spark):
    visits, dim = data(spark)
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        within, beyond = attach_dim(visits, dim, "poi_id", broadcast=BOUNDED), attach_dim(visits, dim, "poi_id", broadcast=BOUNDED, limit=10)
        assert "BroadcastHashJoin" in plan(within) and "Broadcast" not in plan(beyond)
        assert within.exceptAll(beyond).count() == 0 and within.count() == beyond.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
