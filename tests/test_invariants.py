"""Invariants on the test tables: unique keys, dense ranks, reconciled counts, partition independence."""

import pytest
from conftest import SF01
from pyspark.sql import Window
from pyspark.sql import functions as F

from quartermart import catalog as C
from quartermart.plans.attraction_quarter import RANK_SCOPES


@pytest.fixture(scope="module")
def marts(spark):
    return {"uq": C.uq(spark, SF01), "aq": C.aq(spark, SF01), "cq": C.cq(spark, SF01),
            "fact": C.fact(spark, SF01), "dim": C.dim(spark, SF01)}


def _dupes(df, keys):
    return df.groupBy(*keys).count().filter("count > 1").count()


def test_keys_unique(marts):
    assert _dupes(marts["uq"], ["blog_id", "travel_year", "travel_quarter"]) == 0
    assert _dupes(marts["aq"], ["poi_id", "travel_year", "travel_quarter"]) == 0
    assert _dupes(marts["cq"], ["city", "region", "travel_year", "travel_quarter"]) == 0
    assert _dupes(marts["dim"], ["poi_id"]) == 0


def test_ranks_are_one_to_n(marts):
    aq = marts["aq"]
    for col, scope in RANK_SCOPES.items():
        w = Window.partitionBy(*scope)
        bad = (aq.withColumn("_n", F.count(F.lit(1)).over(w))
                 .groupBy(*scope).agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
                                      F.countDistinct(col).alias("d"), F.first("_n").alias("n"))
                 .filter("lo != 1 OR hi != n OR d != n").count())
        assert bad == 0, col


def test_counts_reconcile(marts):
    fact, dim = marts["fact"], marts["dim"]
    inner = fact.join(dim.select("poi_id"), "poi_id").count()
    assert marts["cq"].agg(F.sum("visit_spot_cnt")).first()[0] == inner
    assert marts["aq"].agg(F.sum("visit_total_cnt")).first()[0] == inner
    uq = marts["uq"]
    assert uq.agg(F.sum("total_spot_cnt")).first()[0] == fact.count()
    assert uq.agg(F.sum("trip_total_cnt")).first()[0] == fact.select("trip_id").distinct().count()
    # city map values never exceed trips; categorised visits never exceed visits
    row = uq.select(
        F.max(F.array_max(F.map_values("city_visit_map")) - F.col("trip_total_cnt")).alias("a"),
        F.max(F.aggregate(F.map_values(F.coalesce("cate_visit_map", F.create_map().cast("map<string,bigint>"))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x) - F.col("total_spot_cnt")).alias("b"),
    ).first()
    assert row.a <= 0 and row.b <= 0


@pytest.mark.parametrize("name", ["user_quarter", "attraction_quarter", "city_quarter", "user_portrait",
                                  "top50_attractions", "city_top10", "visits_dedup"])
def test_same_result_under_one_and_many_partitions(spark, name):
    def rows():
        return sorted(tuple(r) for r in C.queries()[name](spark, "/root/testdata/sf0.001").collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = rows()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    many = rows()
    assert one == many and len(one) > 0


def test_plans_agree_under_a_hot_user_and_poi(spark):
    """One user-quarter and one POI hold about a third of all visits: every plan gives the same rows."""
    import datetime as dt

    from quartermart.plans.attraction_quarter import attraction_quarter
    from quartermart.plans.city_quarter import city_quarter
    from quartermart.plans.user_quarter import user_quarter
    base = C.fact(spark, "/root/testdata/sf0.001")
    n = base.count()
    hot = spark.range(n // 2).select(
        F.lit("hot").alias("blog_id"),
        F.concat(F.lit("hot_1999/5/"), (F.col("id") % 28 + 1).cast("string")).alias("trip_id"),
        F.make_date(F.lit(1999), F.lit(5), (F.col("id") % 28 + 1).cast("int")).alias("travel_date"),
        F.lit(1999).alias("travel_year"), F.lit(5).alias("travel_month"),
        F.when(F.col("id") % 3 == 0, "Solo").otherwise("Family").alias("travel_partners"),
        F.when(F.col("id") % 2 == 0, F.lit("1")).otherwise((F.col("id") % 10).cast("string")).alias("poi_id"))
    visits = base.unionByName(hot).repartition(8)
    dim = C.dim(spark, "/root/testdata/sf0.001")

    def same(a, b):
        a, b = C.normalize(a), C.normalize(b)
        return a.count() == b.count() and a.exceptAll(b).count() == 0

    assert same(user_quarter(visits, dim, broadcast=True), user_quarter(visits, dim, broadcast=False))
    assert same(attraction_quarter(visits, dim, broadcast=True), attraction_quarter(visits, dim, broadcast=False))
    assert same(city_quarter(visits, dim, broadcast=True), city_quarter(visits, dim, broadcast=False))
    r = user_quarter(visits, dim, broadcast=True).filter("blog_id = 'hot'").first()
    assert r.total_spot_cnt == n // 2 and r.trip_total_cnt == 28 and r.peak_month == 5
    assert dt.date(1999, 5, 1) == r.first_trip_date
