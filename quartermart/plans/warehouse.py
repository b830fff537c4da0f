"""The layered warehouse run: raw CSV -> ods -> dwd -> dws -> ads tables.

Each layer reads the tables of the previous layer, so every layer starts from
Parquet on shared storage: lineage is cut at each layer boundary, a lost
executor only recomputes inside the current layer, and each layer can be
re-run on its own. Schemas are checked against the declared layer schemas
before every write.

    python -m quartermart.plans.warehouse --poi POIs.csv --trips Visits.csv [--layers ods,dwd,dws,ads]
    python -m quartermart.plans.warehouse --root DIR --jobs user_quarter,portrait   # single jobs on existing tables

With ``--root`` every table is a folder below it, so layers and jobs can run as
separate processes; without, they need a metastore that outlives the process.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.rules import (DEFAULT_CATEGORY_RULES, DEFAULT_REGION_RULES,
                                         CategoryRules, RegionRules)
from quartermart.operators.join import persisted
from quartermart.operators.ranking import RANGE, WINDOW
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import city_quarter
from quartermart.plans.leaderboards import top_attractions, top_cities
from quartermart.plans.poi import clean_poi
from quartermart.plans.portrait import user_portrait
from quartermart.plans.user_quarter import user_quarter
from quartermart.plans.visits import clean_visits
from quartermart.sources import schemas, sinks, versions
from quartermart.sources.buckets import write_bucketed
from quartermart.sources.raw import scan_poi_csv, scan_trip_csv

QUARTER_PARTITION = ["travel_year", "travel_quarter"]
MONTH_PARTITION = ["travel_year", "travel_month"]
#: A user with a large share of all visits has many trips, so trips spread them; the user mart has a row a user and quarter.
TRIP_BUCKETS, USER_BUCKETS = ["trip_id"], ["blog_id"]


@dataclass(frozen=True)
class Tables:
    ods_poi: str = "ods.ods_poi_dim"
    ods_trip: str = "ods.ods_user_travel_sequence"
    ods_reject: str = "ods.ods_rejects"
    dwd_poi: str = "dwd.dwd_poi_info"
    dwd_trip: str = "dwd.dwd_user_trips"
    dwd_visit: str = "dwd.dwd_user_travel_sequence_info"
    dws_user: str = "dws.dws_user_travel_quarter"
    dws_attraction: str = "dws.dws_attraction_travel_quarter"
    dws_city: str = "dws.dws_city_travel_quarter"
    ads_portrait: str = "ads.ads_user_portrait"
    ads_top_attractions: str = "ads.ads_top50_attractions"
    ads_top_cities: str = "ads.ads_city_top10"


@dataclass(frozen=True)
class Config:
    regions: RegionRules = DEFAULT_REGION_RULES
    categories: CategoryRules = DEFAULT_CATEGORY_RULES
    years: tuple[int, int] = K.YEAR_RANGE
    top_attractions: int = K.TOP_ATTRACTIONS
    top_cities: int = K.TOP_CITIES
    broadcast: bool | None = None      # None: the planner chooses (see operators.join)
    rank_form: str = WINDOW            # or RANGE (see operators.ranking); needs spark.checkpoint.dir
    tables: Tables = field(default_factory=Tables)
    root: str | None = None            # folder of all layers; None: tables of the session catalog
    buckets: int | None = None         # visits by trip and user mart by user in that many buckets (catalog only)

    def __post_init__(self):
        if self.rank_form not in (WINDOW, RANGE):
            raise ValueError(f"unknown form of ranking: {self.rank_form}")
        if self.buckets and self.root:
            raise ValueError("buckets are kept by the catalog: leave out root")


def _read(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    return sinks.read_table(spark, name, cfg.root)


def _write(df: DataFrame, cfg: Config, name: str, schema, **how) -> versions.Commit:
    return sinks.overwrite_table(df, name, schema, root=cfg.root, **how)


def load_ods(spark: SparkSession, poi: DataFrame, trip: DataFrame, cfg: Config = Config()) -> None:
    """Raw layer: the two raw inputs (already renamed to snake_case), all text."""
    _write(schemas.conform(poi, schemas.ODS_POI), cfg, cfg.tables.ods_poi, schemas.ODS_POI)
    _write(schemas.conform(trip, schemas.ODS_TRIP), cfg, cfg.tables.ods_trip, schemas.ODS_TRIP)


def load_ods_csv(spark: SparkSession, poi_csv: str, trip_csv: str, cfg: Config = Config()) -> None:
    """Raw layer from CSV files; rows that don't fit their file's header go to the reject table."""
    (poi, bad_poi), (trip, bad_trip) = scan_poi_csv(spark, poi_csv), scan_trip_csv(spark, trip_csv)
    load_ods(spark, poi, trip, cfg)
    rejects = bad_poi.withColumn("source", F.lit("poi")).unionByName(bad_trip.withColumn("source", F.lit("trip")))
    _write(schemas.conform(rejects, schemas.ODS_REJECT), cfg, cfg.tables.ods_reject, schemas.ODS_REJECT)


def job_poi(spark: SparkSession, cfg: Config = Config()) -> None:
    """C2: ods POI -> dwd POI dimension."""
    t = cfg.tables
    _write(clean_poi(_read(spark, cfg, t.ods_poi), cfg.regions, cfg.categories), cfg, t.dwd_poi, schemas.DWD_POI)


def job_visits(spark: SparkSession, cfg: Config = Config()) -> None:
    """C3: ods trips -> dwd visit fact, partitioned by (year, month)."""
    t = cfg.tables
    if cfg.buckets:
        visits = clean_visits(_read(spark, cfg, t.ods_trip), years=cfg.years, cluster_by=TRIP_BUCKETS, buckets=cfg.buckets)
        write_bucketed(visits, t.dwd_visit, TRIP_BUCKETS, cfg.buckets, schemas.DWD_VISIT, MONTH_PARTITION, ready=True)
        return
    visits = clean_visits(_read(spark, cfg, t.ods_trip), years=cfg.years, cluster_by=MONTH_PARTITION)
    _write(visits, cfg, t.dwd_visit, schemas.DWD_VISIT, partition_by=MONTH_PARTITION, rebalance=False)


def job_user_quarter(spark: SparkSession, cfg: Config = Config(), poi: DataFrame | None = None) -> None:
    """C4: dwd visits + POI -> user x quarter mart."""
    t = cfg.tables
    df = user_quarter(_read(spark, cfg, t.dwd_visit), _read(spark, cfg, t.dwd_poi) if poi is None else poi, cfg.broadcast, cfg.categories.unclassified)
    if cfg.buckets:
        write_bucketed(df, t.dws_user, USER_BUCKETS, cfg.buckets, schemas.DWS_USER_QUARTER, QUARTER_PARTITION)
        return
    _write(df, cfg, t.dws_user, schemas.DWS_USER_QUARTER, partition_by=QUARTER_PARTITION)


def job_attraction_quarter(spark: SparkSession, cfg: Config = Config(), poi: DataFrame | None = None) -> None:
    """C5: dwd visits + POI -> attraction x quarter mart."""
    t = cfg.tables
    df = attraction_quarter(_read(spark, cfg, t.dwd_visit), _read(spark, cfg, t.dwd_poi) if poi is None else poi, cfg.broadcast, rank_form=cfg.rank_form)
    _write(df, cfg, t.dws_attraction, schemas.DWS_ATTRACTION_QUARTER, partition_by=QUARTER_PARTITION)


def job_city_quarter(spark: SparkSession, cfg: Config = Config(), poi: DataFrame | None = None) -> None:
    """C6: dwd visits + POI -> city x quarter mart."""
    t = cfg.tables
    df = city_quarter(_read(spark, cfg, t.dwd_visit), _read(spark, cfg, t.dwd_poi) if poi is None else poi, cfg.broadcast, rank_form=cfg.rank_form)
    _write(df, cfg, t.dws_city, schemas.DWS_CITY_QUARTER, partition_by=QUARTER_PARTITION)


def job_portrait(spark: SparkSession, cfg: Config = Config()) -> None:
    """C7: user x quarter mart -> lifetime portrait."""
    t = cfg.tables
    _write(user_portrait(_read(spark, cfg, t.dws_user), clustered=bool(cfg.buckets)), cfg, t.ads_portrait, schemas.ADS_USER_PORTRAIT)


def job_top_attractions(spark: SparkSession, cfg: Config = Config()) -> None:
    """C8: attraction mart -> top-N per quarter."""
    t = cfg.tables
    _write(top_attractions(_read(spark, cfg, t.dws_attraction), cfg.top_attractions), cfg, t.ads_top_attractions, schemas.ADS_TOP_ATTRACTIONS)


def job_top_cities(spark: SparkSession, cfg: Config = Config()) -> None:
    """C9: city mart -> top-N per quarter."""
    t = cfg.tables
    _write(top_cities(_read(spark, cfg, t.dws_city), cfg.top_cities), cfg, t.ads_top_cities, schemas.ADS_CITY_TOP)


def run_dwd(spark: SparkSession, cfg: Config = Config()) -> None:
    job_poi(spark, cfg)
    job_visits(spark, cfg)


def run_dws(spark: SparkSession, cfg: Config = Config()) -> None:
    """The three marts, sharing one cached copy of the POI dimension."""
    with persisted(_read(spark, cfg, cfg.tables.dwd_poi)) as poi:
        job_user_quarter(spark, cfg, poi)
        job_attraction_quarter(spark, cfg, poi)
        job_city_quarter(spark, cfg, poi)


def run_ads(spark: SparkSession, cfg: Config = Config()) -> None:
    job_portrait(spark, cfg)
    job_top_attractions(spark, cfg)
    job_top_cities(spark, cfg)


def run(spark: SparkSession, cfg: Config = Config(), layers=("dwd", "dws", "ads")) -> None:
    """Run the given layers in order (the raw layer is loaded separately)."""
    steps = {"dwd": run_dwd, "dws": run_dws, "ads": run_ads}
    for layer in layers:
        steps[layer](spark, cfg)


JOBS = {
    "poi_clean": job_poi,
    "visits_clean": job_visits,
    "user_quarter": job_user_quarter,
    "attraction_quarter": job_attraction_quarter,
    "city_quarter": job_city_quarter,
    "portrait": job_portrait,
    "top_attractions": job_top_attractions,
    "top_cities": job_top_cities,
}


def configured(p: argparse.ArgumentParser, argv=None) -> tuple[Config, argparse.Namespace, SparkSession]:
    """The options that every command of the warehouse shares, parsed; with the session."""
    from quartermart.session import build_session, ensure_checkpoint_dir

    p.add_argument("--root", help="folder of all layer tables, shared by all processes; default: the session catalog")
    p.add_argument("--years", help="first,last: years kept, the last one excluded")
    p.add_argument("--categories", help='JSON file: [["name", "regex"], ...], tried in order')
    p.add_argument("--table", action="append", default=[], metavar="FIELD=LAYER.NAME", help="rename a table, e.g. dws_user=dws.users")
    p.add_argument("--rank-form", default=WINDOW, choices=[WINDOW, RANGE])
    p.add_argument("--buckets", type=int, help="store visits and the user mart in that many buckets (catalog tables)")
    p.add_argument("--master", default=None, help="only for local runs; clusters pass it via spark-submit")
    a = p.parse_args(argv)
    cfg = Config(root=a.root, rank_form=a.rank_form, buckets=a.buckets, tables=Tables(**dict(x.split("=", 1) for x in a.table)))
    if a.years:
        cfg = replace(cfg, years=tuple(int(y) for y in a.years.split(",")))
    if a.categories:
        with open(a.categories, encoding="utf-8") as f:
            cfg = replace(cfg, categories=replace(cfg.categories, patterns=tuple(map(tuple, json.load(f)))))
    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    if a.rank_form == RANGE:
        ensure_checkpoint_dir(spark)
    return cfg, a, spark


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--poi", help="raw POI CSV (with header)")
    p.add_argument("--trips", help="raw trip CSV (with header)")
    p.add_argument("--layers", default="ods,dwd,dws,ads")
    p.add_argument("--jobs", default=None, help=f"run only these jobs, in order: {','.join(JOBS)}")
    cfg, a, spark = configured(p, argv)
    if a.jobs:
        for name in [x.strip() for x in a.jobs.split(",") if x.strip()]:
            JOBS[name](spark, cfg)
        return
    layers = [x.strip() for x in a.layers.split(",") if x.strip()]
    if "ods" in layers:
        load_ods_csv(spark, a.poi, a.trips, cfg)
    run(spark, cfg, layers=[x for x in layers if x != "ods"])


if __name__ == "__main__":
    main()
