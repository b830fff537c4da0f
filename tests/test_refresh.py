"""Incremental refresh: equal to one full run, untouched partitions keep their files, growth reaches ahead."""

import os

import pytest
from conftest import SF001

from quartermart import catalog as C
from quartermart.functions import constants as K
from quartermart.plans import refresh as R
from quartermart.plans import warehouse as W
from quartermart.sources import binding, schemas, sinks, versions
from quartermart.sources.raw import rename

MARTS = {"dwd_visit": "visits_clean", "dws_user": "user_quarter", "dws_attraction": "attraction_quarter", "dws_city": "city_quarter",
         "ads_portrait": "user_portrait", "ads_top_attractions": "top50_attractions", "ads_top_cities": "city_top10"}
POIS = [("p1", "n", "n", "c", "c", "30.0", "110.0", "湖", "x"), ("p2", "n", "n", "c", "c", "31.0", "111.0", "湖", "x")]


def files(root, table):
    """(partition, file) -> of every data file of a table as its last commit has it."""
    home = os.path.join(root, *table.split("."))
    commit = versions.current(C.SparkSession.getActiveSession(), home)
    return {(p, f) for p, held in commit.places.items() for v in held for f in os.listdir(os.path.join(home, v, p)) if f.endswith(".parquet")}


def loaded(spark, root, trips, pois=None, years=(2011, 2021)):
    cfg = W.Config(root=root, years=years)
    schema = ", ".join(f"{c} string" for c in K.POI_HEADER_RENAMES.values())
    W.load_ods(spark, spark.createDataFrame(pois or POIS, schema), trips, cfg)
    W.run(spark, cfg)
    R.start(spark, cfg)
    return cfg


def trips(spark, rows):
    return spark.createDataFrame([(u, d, d, p, s) for u, d, p, s in rows], ", ".join(f"{c} string" for c in K.TRIP_HEADER_RENAMES.values()))


def same_as_full(spark, tmp_path, cfg, every):
    full = loaded(spark, str(tmp_path / "full"), every, years=cfg.years)
    for field in MARTS:
        name = getattr(cfg.tables, field)
        got, want = (C.normalize(sinks.read_table(spark, name, c.root)) for c in (cfg, full))
        assert got.count() == want.count(), field
        assert got.exceptAll(want.select(*got.columns)).count() == 0, field


def test_two_loads_equal_one_full_run_and_keep_untouched_files(spark, tmp_path):
    root = str(tmp_path)
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE, root=root)
    first, second = (rename(x, K.TRIP_HEADER_RENAMES) for x in binding.two_loads(spark, SF001))
    W.load_ods(spark, C.ods_poi(spark, SF001), first, cfg)
    W.run(spark, cfg)
    R.start(spark, cfg)
    before = {t: files(root, getattr(cfg.tables, t)) for t in ("dwd_visit", "dws_user", "dws_attraction")}
    quarters = R.refresh(spark, second, cfg)
    assert (1997, 2) in quarters and (1996, 1) not in quarters
    for field, name in MARTS.items():
        if name != "visits_clean":     # the copies of two_loads change partners: see the registered queries
            got = sinks.read_table(spark, getattr(cfg.tables, field), root)
            assert got.count() == C.queries()[name](spark, SF001).count(), field
    for field, old in before.items():
        now = files(root, getattr(cfg.tables, field))
        touched = {p for p, _ in old ^ now}
        kept = {p for p, _ in old & now}
        assert "travel_year=1996/travel_quarter=1" in kept or "travel_year=1996/travel_month=1" in kept
        assert not touched & kept
        if field == "dws_user":
            assert kept == {p for p, _ in old} - {f"travel_year={y}/travel_quarter={q}" for y, q in quarters}


def test_growth_reaches_the_next_quarter_present(spark, tmp_path):
    old = [("u1", "2015/1/5", "Solo", "p1"), ("u1", "2016/8/5", "Solo", "p1;p2"), ("u2", "2017/2/1", "Solo", "p2"), ("u1", "2018/2/1", None, "p1")]
    late = [("u3", "2015/2/2", "Solo", "p1"), ("u4", "2015/5/2", "Solo", "p1"), ("u5", "2015/5/3", "Solo", "p1")]     # p1's next quarter is 2016 Q3
    cfg = loaded(spark, str(tmp_path / "inc"), trips(spark, old))
    mart = cfg.tables.dws_attraction
    before = files(cfg.root, mart)
    assert R.refresh(spark, trips(spark, late), cfg) == [(2015, 1), (2015, 2)]
    now = files(cfg.root, mart)
    assert {p for p, _ in before & now} == {"travel_year=2017/travel_quarter=1", "travel_year=2018/travel_quarter=1"}
    same_as_full(spark, tmp_path, cfg, trips(spark, old + late))


def test_arriving_trips_are_computed_once(spark, tmp_path):
    old = [("u1", "2015/1/5", "Solo", "p1"), ("u2", "2015/4/5", "Solo", "p1;p2")]
    late = [("u5", "2015/4/6", "Solo", "p2"), ("u6", "2015/5/6", "Solo", "p2")]
    cfg = loaded(spark, str(tmp_path / "inc"), trips(spark, old))
    seen, rows = spark.sparkContext.accumulator(0), trips(spark, late)

    def counted(row):
        seen.add(1)
        return row

    R.refresh(spark, spark.createDataFrame(rows.rdd.map(counted), rows.schema), cfg)
    assert seen.value == len(late)
    same_as_full(spark, tmp_path, cfg, trips(spark, old + late))


def test_counts_of_a_refreshed_mart_are_computed_once(spark, tmp_path):
    """Growth is looked at before the changed quarters are known; the counts behind it stay for the write."""
    cfg = loaded(spark, str(tmp_path), trips(spark, [("u1", "2015/1/5", "Solo", "p1"), ("u2", "2015/4/5", "Solo", "p1")]))
    mart = sinks.read_table(spark, cfg.tables.dws_attraction, cfg.root)
    seen, fresh = spark.sparkContext.accumulator(0), mart.where("travel_quarter = 1")

    def counted(row):
        seen.add(1)
        return row

    rows = spark.createDataFrame(fresh.rdd.map(counted), mart.schema)
    R._refresh_mart(spark, cfg, cfg.tables.dws_attraction, schemas.DWS_ATTRACTION_QUARTER, rows, [(2015, 1)], ["poi_id"], "visit_user_cnt")
    assert seen.value == 1
    assert sinks.read_table(spark, cfg.tables.dws_attraction, cfg.root).count() == 2


def test_two_loads_read_kept_trips(spark):
    kept = []
    first, second = binding.two_loads(spark, SF001, lambda df, name: kept.append(name) or df)
    assert kept == ["raw_trips"]
    orders = binding.raw_trip(spark, SF001)
    assert second.exceptAll(orders).count() == 0 and first.where("Travel_Partners = 'zz'").count() > 0
    assert first.where("Travel_Partners is null or Travel_Partners <> 'zz'").unionByName(second).exceptAll(orders).count() == 0
    assert first.where("Travel_Partners is null or Travel_Partners <> 'zz'").count() + second.count() == orders.count()


@pytest.mark.parametrize("late", [
    [("u1", "2015/1/5", "A", "p1")],                                          # a copy with a smaller partner
    [("u1", "2015/1/5", "Solo", "p1")],                                       # nothing new
    [("u9", "2010/1/5", "Solo", "p1"), ("u9", "bad", "Solo", "p1"), (None, "2015/1/5", "Solo", "p1")],   # nothing that counts
    [("u1", "2015/3/31", "Solo", "p1;;p9 "), ("u2", "2015/4/1", None, " ")],  # unknown places, a visit list of blanks
])
def test_small_arrivals(spark, tmp_path, late):
    old = [("u1", "2015/1/5", "Solo", "p1"), ("u2", "2015/4/5", "Solo", "p1;p2"), ("u1", "2016/2/1", None, "p2")]
    cfg = loaded(spark, str(tmp_path / "inc"), trips(spark, old))
    R.refresh(spark, trips(spark, late), cfg)
    R.refresh(spark, trips(spark, late), cfg)      # again: nothing changes
    same_as_full(spark, tmp_path, cfg, trips(spark, old + late))


def test_command_line(spark, tmp_path):
    old = [("u1", "2015/1/5", "Solo", "p1"), ("u2", "2015/4/5", "Solo", "p1;p2")]
    cfg = loaded(spark, str(tmp_path / "inc"), trips(spark, old))
    header = ",".join(K.TRIP_HEADER_RENAMES)
    (tmp_path / "new.csv").write_text(f"{header}\nu5,2015/4/6,2015/4/6,Solo,p2\nu6,2015/4/6\n", encoding="utf-8")
    sinks.overwrite_table(spark.createDataFrame([], "source string, file string, reason string, line string"), cfg.tables.ods_reject, root=cfg.root)
    R.main(["--root", cfg.root])
    R.main(["--root", cfg.root, "--trips", str(tmp_path / "new.csv")])
    same_as_full(spark, tmp_path, cfg, trips(spark, [*old, ("u5", "2015/4/6", "Solo", "p2")]))
    bad = sinks.read_table(spark, cfg.tables.ods_reject, cfg.root).collect()
    assert [(r.source, r.reason, r.line) for r in bad] == [("trip", "short", "u6,2015/4/6")]
    assert sinks.read_table(spark, cfg.tables.ods_trip, cfg.root).count() == 3
