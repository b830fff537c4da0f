"""The layered run writes every table, and the tables equal the registered queries."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001

from quartermart import catalog as C
from quartermart.plans import warehouse as W
from quartermart.sources import binding


def test_layered_run_matches_queries(spark):
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE)
    W.load_ods(spark, C.ods_poi(spark, SF001), C.ods_trip(spark, SF001), cfg)
    W.run(spark, cfg)
    t = cfg.tables
    pairs = [(t.dwd_poi, "poi_clean"), (t.dwd_visit, "visits_clean"), (t.dws_user, "user_quarter"),
             (t.dws_attraction, "attraction_quarter"), (t.dws_city, "city_quarter"),
             (t.ads_portrait, "user_portrait"), (t.ads_top_attractions, "top50_attractions"),
             (t.ads_top_cities, "city_top10")]
    qs = C.queries()
    for table, name in pairs:
        want = qs[name](spark, SF001)
        got = C.normalize(spark.table(table)).select(*want.columns)
        assert got.count() == want.count() > 0, table
        assert got.exceptAll(want).count() == 0, table
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {t.dws_user}").collect()}
    assert "travel_year=1995/travel_quarter=1" in parts


def test_layered_run_from_csv_files(spark, tmp_path):
    """C1 from headered CSV files (the original raw format) through every layer."""
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE)
    poi_csv, trip_csv = str(tmp_path / "pois"), str(tmp_path / "trips")
    binding.raw_poi(spark, SF001).write.option("header", True).csv(poi_csv)
    binding.raw_trip(spark, SF001).write.option("header", True).csv(trip_csv)
    W.load_ods_csv(spark, poi_csv, trip_csv, cfg)
    W.run(spark, cfg)
    want = C.queries()["top50_attractions"](spark, SF001)
    got = C.normalize(spark.table(cfg.tables.ads_top_attractions)).select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    portrait = C.queries()["user_portrait"](spark, SF001)
    assert spark.table(cfg.tables.ads_portrait).count() == portrait.count()


def test_cli_runs_single_jobs(spark):
    """The CLI re-runs one job on the existing layer tables (here: the two leaderboards)."""
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE)
    W.load_ods(spark, C.ods_poi(spark, SF001), C.ods_trip(spark, SF001), cfg)
    W.run(spark, cfg, layers=("dwd", "dws"))
    spark.sql(f"DROP TABLE IF EXISTS {cfg.tables.ads_top_cities}")
    W.main(["--jobs", "top_cities"])
    assert spark.table(cfg.tables.ads_top_cities).count() == C.queries()["city_top10"](spark, SF001).count()
    assert set(W.JOBS) == {"poi_clean", "visits_clean", "user_quarter", "attraction_quarter", "city_quarter",
                           "portrait", "top_attractions", "top_cities"}


def test_layers_run_as_separate_processes(spark, tmp_path):
    """One process a layer on a root folder, then the whole chain again: the tables equal the registered queries."""
    binding.raw_poi(spark, SF001).write.option("header", True).csv(str(tmp_path / "pois"))
    binding.raw_trip(spark, SF001).write.option("header", True).csv(str(tmp_path / "trips"))
    (tmp_path / "rules.json").write_text(json.dumps(binding.TEST_CATEGORY_RULES.patterns, ensure_ascii=False), encoding="utf-8")
    root = str(tmp_path / "layers")
    years = ",".join(map(str, binding.TEST_YEAR_RANGE))

    def process(*args):
        subprocess.run([sys.executable, "-m", "quartermart.plans.warehouse", "--root", root, "--master", "local[2]", "--years", years,
                        "--categories", str(tmp_path / "rules.json"), "--table", "ads_top_cities=ads.best_cities", *args],
                       check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, timeout=300)

    raw = ["--poi", str(tmp_path / "pois"), "--trips", str(tmp_path / "trips")]
    process("--layers", "ods,dwd", *raw)
    process("--layers", "dws")
    process("--layers", "ads")
    process("--layers", "ods,dwd", *raw)   # again, over what is there
    for folder, name in (("dws/dws_user_travel_quarter", "user_quarter"), ("ads/ads_user_portrait", "user_portrait"), ("ads/best_cities", "city_top10")):
        want = C.queries()[name](spark, SF001)
        got = C.normalize(spark.read.parquet(f"{root}/{folder}")).select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0, name
