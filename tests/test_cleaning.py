"""Cleaning rules: region and category rules, bounding box, dates, years, explode, dedupe."""

import datetime as dt

from quartermart.functions import constants as K
from quartermart.functions.rules import DEFAULT_CATEGORY_RULES, DEFAULT_REGION_RULES
from quartermart.operators import clean
from quartermart.plans import poi as poi_plan
from quartermart.plans import visits as visit_plan


def test_region_borders(spark):
    pts = [(40, 120), (39.99, 119.99), (35, 110), (35, 109.99), (28, 115), (28, 110), (27.99, 110),
           (40, 115), (36, 120.4), (32.5, 109)]
    want = ["东北", "华北", "华北", "西北", "华东", "华中", "华南", "西南", "西南", "西南"]
    df = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(pts)],
                               "i int, latitude double, longitude double")
    got = [r.region for r in df.select("i", DEFAULT_REGION_RULES.column().alias("region"))
           .orderBy("i").collect()]
    assert got == want


def test_bounding_box_inclusive(spark):
    rows = [("a", 3.99, 100.0), ("b", 4.0, 100.0), ("c", 54.0, 100.0), ("d", 54.01, 100.0),
            ("e", 30.0, 72.99), ("f", 30.0, 73.0), ("g", 30.0, 135.0), ("h", 30.0, 135.01)]
    df = spark.createDataFrame(rows, "k string, latitude double, longitude double")
    kept = {r.k for r in clean.in_range(df, {"latitude": K.LATITUDE_RANGE,
                                             "longitude": K.LONGITUDE_RANGE}).collect()}
    assert kept == {"b", "c", "f", "g"}


def test_category_first_match_and_defaults(spark):
    df = spark.createDataFrame([(1, "博物馆;城市公园"), (2, "乐园;博物馆"), (3, None), (4, "无关"),
                                (5, "山")], "i int, label_zh string")
    df = clean.fill(df, {"label_zh": K.NO_LABEL})
    got = [r.c for r in df.select("i", DEFAULT_CATEGORY_RULES.column("label_zh").alias("c"))
           .orderBy("i").collect()]
    assert got == ["文化场馆", "主题游乐", "未分类", "其他景点", "自然风光"]


def test_poi_cleaning_casts_and_drops(spark):
    rows = [("1", "n", "c", "30.5", "110.5", "公园;广场"), ("2", "n", "c", "abc", "110", None),
            ("3", None, "c", "30", "110", None), ("4", "n", "c", "60", "110", None),
            ("1", "m", "c", "31", "111", None)]
    ods = spark.createDataFrame([(a, b, None, c, None, d, e, f, None) for a, b, c, d, e, f in rows],
                                ", ".join(f"{c} string" for c in
                                          ["poi_id", "name_zh", "name_en", "city_zh", "city_en",
                                           "latitude", "longitude", "label_zh", "label_en"]))
    out = {r.poi_id: r for r in poi_plan.clean_poi(ods).collect()}
    assert set(out) == {"1"}                      # bad number, null name, outside box dropped
    r = out["1"]
    assert r.name == "m"                          # smallest row wins for a repeated id
    assert r.label == ["无标签"] and r.category == "未分类"
    raw = {r.name: r for r in poi_plan.clean_poi(ods, unique=False).collect()}
    assert raw["n"].label == ["公园", "广场"] and raw["n"].category == "都市休闲"
    assert raw["n"].region == "华中"


def _ods_trip(spark, rows):
    return spark.createDataFrame(rows, "blog_id string, retrieval_date string, departure_date string, "
                                       "travel_partners string, visit_sequence string")


def test_dates_years_and_rejects(spark):
    rows = [("u1", None, "2020/1/1", "Solo", "1"), ("u2", None, "2020-1-1", "Solo", "1"),
            ("u3", None, "2020/02/30", None, "1"), ("u4", None, None, "Solo", "1"),
            ("u5", None, "2010/5/5", "Solo", "1"), ("u6", None, "2011/5/5", "Solo", "1"),
            ("u7", None, "2021/12/31", "Solo", "1"), ("u8", None, "2022/1/1", "Solo", "1")]
    ods = _ods_trip(spark, rows)
    rejected = sorted(r.departure_date for r in visit_plan.rejected_dates(ods).collect())
    assert rejected == ["2020-1-1", "2020/02/30"]
    v = {r.blog_id: r for r in visit_plan.clean_visits(ods).collect()}
    assert set(v) == {"u1", "u6", "u7"}
    assert v["u1"].travel_date == dt.date(2020, 1, 1) and v["u1"].trip_id == "u1_2020/1/1"
    assert (v["u7"].travel_year, v["u7"].travel_month) == (2021, 12)


def test_explode_drops_blanks_and_trims(spark):
    ods = _ods_trip(spark, [("u", None, "2020/3/1", None, "a;;b; ;c;"), ("w", None, "2020/3/1", None, " 12")])
    v = visit_plan.clean_visits(ods).collect()
    assert sorted(r.poi_id for r in v if r.blog_id == "u") == ["a", "b", "c"]
    assert [r.poi_id for r in v if r.blog_id == "w"] == ["12"]
    assert {r.travel_partners for r in v} == {K.UNRECORDED_PARTNER}


def test_dedupe_keeps_smallest_partner(spark):
    ods = _ods_trip(spark, [("u", None, "2020/3/1", "Solo", "1;2"), ("u", None, "2020/3/1", "Family", "1;2"),
                            ("u", None, "2020/3/1", "Solo", "3")])
    trips = visit_plan.trips_in_years(ods).collect()
    assert sorted((r.visit_sequence, r.travel_partners) for r in trips) == [("1;2", "Family"), ("3", "Solo")]
    assert len({r.trip_id for r in trips}) == 1   # one user and date is one trip


def test_dedupe_skew_group_is_combined(spark):
    """A group of copies holding most rows is reduced by the partial aggregate."""
    rows = [("u", "2020/3/1", "Solo" if i % 2 else "Family", "1;2") for i in range(2000)]
    rows += [(f"v{i}", "2020/3/1", "Solo", "1") for i in range(50)]
    df = spark.createDataFrame(rows, "blog_id string, departure_date string, travel_partners string, "
                                     "visit_sequence string").repartition(8)
    out = clean.dedupe(df, ["blog_id", "departure_date", "visit_sequence"], smallest=["travel_partners"])
    got = {r.blog_id: r.travel_partners for r in out.collect()}
    assert len(got) == 51 and got["u"] == "Family"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_profiles(spark):
    from quartermart.operators import profile
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0), ("c", 4.0)], "k string, x double")
    b = profile.bounds(df, ["x"]).first()
    assert (b.min_x, b.max_x) == (1.0, 4.0)
    top = [(r.k, r["count"]) for r in profile.frequency(df, ["k"], n=2).collect()]
    assert top == [("a", 2), ("b", 1)]
