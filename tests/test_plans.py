"""Physical plan properties: pruning reaches the scan, broadcasts are measured, shuffles are few."""

import re
import tempfile

import pytest

from conftest import SF001, SF01, poi_df, visits_df

from quartermart import catalog as C
from quartermart.operators.join import attach_dim, measure
from quartermart.plans.attraction_quarter import attraction_counts, attraction_quarter
from quartermart.plans.city_quarter import city_counts, city_quarter
from quartermart.plans.portrait import portrait_entries, user_portrait
from quartermart.plans.user_quarter import user_quarter


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    path = tempfile.mkdtemp(prefix="qm-plan-") + "/visits"
    C.fact(spark, SF001).write.parquet(path)
    visits = spark.read.parquet(path)
    df = attraction_quarter(visits, C.dim(spark, SF001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "visits" in line][0]
    read_schema = scan.split("ReadSchema:")[1]
    assert "travel_month" not in read_schema            # the quarter comes from the date
    assert "IsNotNull(poi_id)" in scan                  # the inner join's filter reaches the scan


def test_broadcast_only_when_measured_small(spark):
    dim = C.dim(spark, SF01).select("poi_id", "name", "city", "category", "region")
    size = measure(dim)
    assert size.rows == 96 and 0 < size.bytes < 1 << 20
    fact = C.fact(spark, SF01)
    assert "BroadcastHashJoin" in _plan(attach_dim(fact, dim, "poi_id", broadcast=True, limit=size.bytes))
    with pytest.raises(ValueError, match="may be broadcast"):
        attach_dim(fact, dim, "poi_id", broadcast=True, limit=size.bytes - 1)


def test_attraction_non_broadcast_path_agrees(spark):
    fact, dim = C.fact(spark, SF01), C.dim(spark, SF01)
    a = C.normalize(attraction_quarter(fact, dim, broadcast=True))
    b = C.normalize(attraction_quarter(fact, dim, broadcast=False)).cache()
    assert a.count() == b.count() == 2592 and a.exceptAll(b).count() == 0
    b.unpersist()


@pytest.mark.parametrize("mart", [user_quarter, attraction_quarter, city_quarter])
def test_forced_shuffle_join_is_final(spark, mart):
    """``broadcast=False`` holds in the plan that ran, after adaptive re-planning."""
    df = mart(C.fact(spark, SF001), C.dim(spark, SF001), broadcast=False)
    df.collect()
    ran = _plan(df)
    assert "isFinalPlan=true" in ran and "SortMergeJoin" in ran
    assert not re.search(r"BroadcastHashJoin \[poi_id", ran)


def test_user_quarter_scans_the_fact_once(spark):
    path = tempfile.mkdtemp(prefix="qm-plan-") + "/visits"
    C.fact(spark, SF001).write.parquet(path)
    plan = _plan(user_quarter(spark.read.parquet(path), C.dim(spark, SF001)))
    assert sum("FileScan parquet" in line and "/visits" in line for line in plan.splitlines()) == 1


def test_city_quarter_makes_no_row_threefold(spark):
    """Users and places of a city are counted by plain grouping, without an Expand; users and partners may be null."""
    visits = visits_df(spark, [("u1", "2015-01-05", "Solo", "p1"), ("u1", "2015-01-05", None, "p1"), ("u2", "2015-02-05", "A", "p2"),
                               (None, "2015-02-06", "Solo", "p2"), ("u1", "2015-03-05", "A", "p3"), ("u3", "2015-03-05", "A", "gone")])
    poi = poi_df(spark, [("p1", "c", "k", "r"), ("p2", "c", "k", "r"), ("p3", "d", "k", None)])
    df = city_counts(visits, poi)
    assert "Expand" not in _plan(df)
    assert sorted(tuple(r)[:1] + tuple(r)[4:] for r in df.collect()) == [("c", 2, 4, 4, 2, 2), ("d", 1, 1, 1, 1, 0)]


def test_attraction_counts_hold_users_and_trips_apart(spark):
    """Users and trips of a place are counted by a plain grouping each, over shuffles that run once; any column may be null."""
    visits = visits_df(spark, [("u1", "2015-01-05", "Solo", "p1"), ("u1", "2015-01-05", None, "p1"), ("u1", "2015-02-05", "Solo", "p1"),
                               (None, "2015-02-06", "A", "p1"), ("u2", "2015-05-05", "A", "p1"), ("u2", "2015-05-05", "A", None), ("u1", "2015-05-05", "Solo", None)])
    df = attraction_counts(visits.unionByName(visits.limit(1).selectExpr("blog_id", "cast(null as string) trip_id", *visits.columns[2:])))
    assert "Expand" not in _plan(df)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}
    assert got == {("p1", 2015, 1): (1, 3, 5, 3), ("p1", 2015, 2): (1, 1, 1, 0), (None, 2015, 2): (2, 2, 2, 1)}
    counts = attraction_counts(C.fact(spark, SF001))
    counts.collect()
    ran = _plan(counts).split("Initial Plan")[0]
    assert ran.count("FileScan parquet") <= _plan(C.fact(spark, SF001)).count("FileScan parquet"), "the visits are put together twice"


def test_user_quarter_collects_once_and_expands_nothing(spark):
    """Visits are counted by a hash aggregate and collected once a user-quarter: no sets a trip, no rows a set's value."""
    path = tempfile.mkdtemp(prefix="qm-plan-") + "/visits"
    C.fact(spark, SF001).write.parquet(path)
    dim = tempfile.mkdtemp(prefix="qm-plan-") + "/dim"
    C.dim(spark, SF001).write.parquet(dim)
    plan = _plan(user_quarter(spark.read.parquet(path), spark.read.parquet(dim)))
    assert plan.count("ObjectHashAggregate(") == 2 and "Generate" not in plan and "SortAggregate" not in plan


def test_user_quarter_compares_no_entries_each_with_each(spark):
    """Pairs of (city, trip) and (trip, region) become distinct by sorting: ``array_distinct`` of structs is quadratic."""
    visits = visits_df(spark, [("u1", "2015-01-05", "Solo", "p1"), ("u1", "2015-01-05", "Solo", "p2"), ("u1", "2015-01-05", "A", "p3"),
                               ("u1", "2015-02-05", "Solo", "p1"), ("u1", "2015-02-06", "Solo", "gone")])
    poi = poi_df(spark, [("p1", "c", "k", "r"), ("p2", "c", "l", "r"), ("p3", "d", "k", "s")])
    df = user_quarter(visits, poi)
    assert "array_sort(" not in df._jdf.queryExecution().analyzed().toString()
    (row,) = df.collect()
    assert row.city_visit_map == {"c": 2, "d": 1} and row.cross_region_trip_cnt == 1 and row.region_arr == ["r", "s"]
    assert row.cate_visit_map == {"k": 3, "l": 1} and row.trip_total_cnt == 3 and row.total_spot_cnt == 5


def test_portrait_runs_no_lambda_for_an_entry(spark):
    mart = spark.createDataFrame(C.uq(spark, SF001).collect(), C.uq(spark, SF001).schema)
    entries = portrait_entries(mart)
    assert "lambdafunction" not in entries._jdf.queryExecution().analyzed().toString()


def test_portrait_shuffles_once(spark):
    mart = spark.createDataFrame(C.uq(spark, SF001).collect(), C.uq(spark, SF001).schema)
    full = user_portrait(mart)._jdf.queryExecution().executedPlan().toString()
    assert full.count("Exchange") == 1 and "Exchange hashpartitioning(blog_id" in full


def test_measure_counts_bytes_not_characters(spark):
    df = spark.createDataFrame([("无标签",), ("ab",)], "s string")
    size = measure(df)
    assert size.rows == 2 and size.bytes == (9 + 8) + (2 + 8) + 2 * 16
