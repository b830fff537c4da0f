"""Mart semantics on literal rows: unmatched POIs, ties, peak month, levels, growth, city key, solo ratio."""

from conftest import poi_df, visits_df

from quartermart.operators.growth import growth
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import city_quarter
from quartermart.plans.leaderboards import top_attractions, top_cities
from quartermart.plans.portrait import user_portrait
from quartermart.plans.user_quarter import user_quarter

POIS = [("p1", "A", "cat1", "r1"), ("p2", "B", "cat2", "r1"), ("p3", "C", "未分类", "r2"),
        ("p4", "A", "cat1", "r2")]


def _uq(spark, rows, pois=POIS, **kw):
    """Either join must give the same rows; returns them keyed by user-quarter."""
    v, p = visits_df(spark, rows), poi_df(spark, pois)
    rows = user_quarter(v, p, broadcast=True, **kw).collect()
    shuffled = user_quarter(v, p, broadcast=False, **kw).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, shuffled))
    return {(r.blog_id, r.travel_year, r.travel_quarter): r for r in rows}


def test_unmatched_pois_count_but_leave_maps_empty(spark):
    out = _uq(spark, [("u", "2020-01-05", "Solo", "zz"), ("u", "2020-01-05", "Solo", "yy")])
    r = out[("u", 2020, 1)]
    assert r.total_spot_cnt == 2 and r.trip_total_cnt == 1
    assert r.city_visit_map == {} and r.unique_city_cnt == 0 and r.top_city == []
    assert r.region_arr == [] and r.region_type is None
    assert r.cate_visit_map is None and r.top_category is None and r.unique_category_cnt == 0
    assert r.solo_trip_ratio == 1.0


def test_city_ties_and_unclassified(spark):
    rows = [("u", "2020-02-01", "Family", "p1"), ("u", "2020-02-01", "Family", "p2"),
            ("u", "2020-02-01", "Family", "p3"), ("u", "2020-02-01", "Family", "p3")]
    r = _uq(spark, rows)[("u", 2020, 1)]
    assert r.top_city == ["A", "B", "C"]           # all tied at one trip, sorted
    assert r.city_visit_map == {"A": 1, "B": 1, "C": 1}
    assert r.cate_visit_map == {"cat1": 1, "cat2": 1}   # unclassified is not a category
    assert r.unique_category_cnt == 2
    assert r.cross_region_trip_cnt == 1 and r.region_arr == ["r1", "r2"]
    assert r.region_type == "全国型" and r.avg_spot_per_trip == 4.0


def test_peak_month_tie_goes_to_earlier_month(spark):
    rows = [("u", "2020-01-03", "x", "p1"), ("u", "2020-01-03", "x", "p2"),
            ("u", "2020-02-03", "x", "p1"), ("u", "2020-02-03", "x", "p2")]
    r = _uq(spark, rows)[("u", 2020, 1)]
    assert r.peak_month == 1 and r.trip_total_cnt == 2
    assert str(r.first_trip_date) == "2020-01-03" and str(r.last_trip_date) == "2020-02-03"


def test_quarter_levels(spark):
    rows = []
    for user, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4)):
        rows += [(user, f"2020-0{1 + i % 3}-{10 + i:02d}", "x", "p1") for i in range(n)]
    out = _uq(spark, rows)
    assert [out[(u, 2020, 1)].travel_level for u in "abcd"] == ["低频", "中频", "中频", "高频"]
    assert out[("a", 2020, 1)].region_type == "单城型"
    assert out[("d", 2020, 1)].avg_trip_per_month == 1.3333


def test_solo_uses_smallest_partner_of_trip(spark):
    rows = [("u", "2020-04-01", "Solo", "p1", ""), ("u", "2020-04-01", "Family", "p2", ""),
            ("u", "2020-05-01", "Solo", "p1"), ("u", "2020-05-01", "Unrecorded", "p1")]
    r = _uq(spark, rows)[("u", 2020, 2)]
    assert r.trip_total_cnt == 2 and r.solo_trip_ratio == 0.5
    assert r.partner_arr == ["Family", "Solo", "Unrecorded"]
    assert r.region_type == "区域型"


def test_growth_previous_present_row(spark):
    df = spark.createDataFrame([("p", 2020, 1, 10), ("p", 2020, 2, 13), ("p", 2020, 4, 14), ("q", 2020, 1, 10),
                                ("q", 2020, 2, 14), ("z", 2020, 1, 0), ("z", 2020, 2, 5)],
                               "poi_id string, travel_year int, travel_quarter int, visit_user_cnt long")
    got = {(r.poi_id, r.travel_quarter): (r.user_cnt_growth_rate, r.is_hot_rising)
           for r in growth(df, ["poi_id"], "visit_user_cnt").collect()}
    assert got[("p", 1)] == (0.0, "无上期数据")
    assert got[("p", 2)] == (0.3, "否")
    assert got[("q", 2)] == (0.4, "是")
    assert got[("p", 4)] == (0.0769, "否")          # compared with Q2, the last present row
    assert got[("z", 2)] == (0.0, "否")             # previous is 0
    strict = {(r.poi_id, r.travel_quarter): r.is_hot_rising
              for r in growth(df, ["poi_id"], "visit_user_cnt", strict=True).collect()}
    assert strict[("p", 4)] == "无上期数据"


def test_city_in_two_regions_is_two_rows(spark):
    pois = [("p1", "A", "c", "r1"), ("p2", "A", "c", "r2")]
    rows = [("u", "2020-01-05", "x", "p1"), ("v", "2020-01-05", "x", "p2"), ("v", "2020-04-05", "x", "p2")]
    for b in (True, False):
        out = city_quarter(visits_df(spark, rows), poi_df(spark, pois), broadcast=b).collect()
        assert sorted((r.city, r.region, r.travel_quarter) for r in out) == \
            [("A", "r1", 1), ("A", "r2", 1), ("A", "r2", 2)]
        q2 = [r for r in out if r.travel_quarter == 2][0]
        assert q2.is_hot_rising == "否" and q2.user_cnt_growth_rate == 0.0


def test_attraction_solo_ratio_can_exceed_one(spark):
    rows = [("u", "2020-01-05", "Solo", "p1"), ("u", "2020-01-05", "Solo", "p1"),
            ("w", "2020-01-05", "Family", "p2"), ("w", "2020-01-05", "Family", "zz")]
    out = {r.poi_id: r for r in attraction_quarter(visits_df(spark, rows), poi_df(spark, POIS)).collect()}
    assert set(out) == {"p1", "p2"}                 # unmatched POI dropped (inner join)
    assert out["p1"].solo_user_ratio == 2.0 and out["p1"].visit_total_cnt == 2
    assert out["p1"].visit_trip_cnt == 1 and out["p1"].visit_user_cnt == 1
    assert out["p1"].user_rank_overall == 1 and out["p2"].user_rank_overall == 2  # tie -> smaller id


def test_leaderboards_filter_existing_rank_and_recompute_agree(spark):
    rows = [(f"u{i}", "2020-01-05", "x", f"p{1 + i % 4}") for i in range(13)]
    aq = attraction_quarter(visits_df(spark, rows), poi_df(spark, POIS))
    a = [(r.poi_id, r.rank) for r in top_attractions(aq, n=2).collect()]
    b = [(r.poi_id, r.rank) for r in top_attractions(aq, n=2, recompute=True).collect()]
    assert a == b == [("p1", 1), ("p2", 2)]
    assert top_attractions(aq, n=2).first().year_quarter == "2020Q1"
    cq = city_quarter(visits_df(spark, rows), poi_df(spark, POIS))
    c = [(r.city, r.region, r.rank) for r in top_cities(cq, n=10).collect()]
    assert c == [("A", "r1", 1), ("A", "r2", 2), ("B", "r1", 3), ("C", "r2", 4)]


def test_portrait(spark):
    rows = [("u", "2019-01-05", "Solo", "p1"), ("u", "2019-01-05", "Solo", "p2"),
            ("u", "2019-04-05", "Family", "p2"), ("u", "2020-07-05", "Family", "p1"),
            ("v", "2020-01-01", "Family", "zz")]
    mart = user_quarter(visits_df(spark, rows), poi_df(spark, POIS))
    out = {r.blog_id: r for r in user_portrait(mart).collect()}
    u = out["u"]
    assert (u.total_trips, u.total_spots, u.active_years) == (3, 4, 2)
    assert (u.first_active_year, u.last_active_year) == (2019, 2020)
    assert u.total_cities == 2 and u.total_regions == 1
    assert u.favorite_city == ["A", "B"] and u.favorite_category == ["cat1", "cat2"]
    assert u.avg_spots_per_trip == 1.33 and u.solo_trip_ratio == 0.33
    assert u.travel_level == "中频" and u.region_type == "区域型"
    v = out["v"]
    assert v.total_cities is None and v.total_regions is None and v.favorite_city is None
    assert v.region_type == "单城型" and v.travel_level == "中频"


def test_distributed_rank_equals_window_rank(spark):
    from quartermart.operators.ranking import rank_in
    rows = [(f"p{i:04d}", f"s{i % 3}", i % 7 if i % 5 else 1, 2020, 1 + i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "poi_id string, scope string, v long, travel_year int, travel_quarter int")
    scopes = {"r_all": ["travel_year", "travel_quarter"], "r_scope": ["scope", "travel_year", "travel_quarter"]}
    win = rank_in(df, scopes, "v", ["poi_id"], form="window")
    dist = rank_in(df.repartition(5), scopes, "v", ["poi_id"], form="range")
    key = ["poi_id", "r_all", "r_scope"]
    a = sorted(tuple(r) for r in win.select(*key).collect())
    b = sorted(tuple(r) for r in dist.select(*key).collect())
    assert a == b and len(a) == 600
