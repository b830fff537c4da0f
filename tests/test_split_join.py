"""Joins of heavy keys: equal to a plain join, no task with more than its share."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from quartermart.operators import join as J


@pytest.fixture
def tables(spark):
    n = 30_000
    fact = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9 != 1, F.concat(F.lit("k"), F.col("id") % 997)).alias("k"))
    dim = spark.createDataFrame([("hot", "h")] + [(f"k{i}", f"d{i}") for i in range(900)], "k string, d string")
    return fact.repartition(8), dim


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy", [None, [], ["hot", None, "k1", "absent"]])
def test_equals_a_plain_join(spark, tables, how, heavy):
    fact, dim = tables
    got, want = J.split_join(fact, dim, "k", how, heavy=heavy), fact.join(dim, "k", how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_heavy_keys_are_found_and_null_is_none(spark, tables):
    assert J.heavy_keys(tables[0], "k") == ["hot"]
    assert J.heavy_keys(tables[0].where("1 = 0"), "k") == []
    assert J.heavy_keys(tables[0].where("k is null"), "k") == []


def test_no_task_gets_more_than_twice_the_median_without_aqe(spark, tables):
    fact, dim = tables
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        split, plain = rows(J.split_join(fact, dim, "k")), rows(fact.join(dim.hint("merge"), "k", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(split) <= 2 * median(split) and max(plain) > 2 * median(plain)


def test_forms_are_checked(spark, tables):
    fact, dim = tables
    with pytest.raises(ValueError, match="left or inner"):
        J.split_join(fact, dim, "k", "full")
    assert J.attach_dim(fact, dim, "k", broadcast=J.SPLIT).count() == fact.count()
