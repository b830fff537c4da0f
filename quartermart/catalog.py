"""Registered queries: one per operator or job of the warehouse, over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Results are the
library's own frames with comparison-friendly types: integers as bigint and
arrays / maps as sorted text (``a,b`` and ``k:v,k:v``); the library itself
keeps native types. Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermart.functions import constants as K
from quartermart.functions.collect import array_text, map_text
from quartermart.functions.rules import DEFAULT_CATEGORY_RULES, DEFAULT_REGION_RULES
from quartermart.operators import clean, profile, top, words
from quartermart.operators.join import BOUNDED, SPLIT, attach_dim
from quartermart.operators.ranking import RANGE
from quartermart.plans import poi as poi_plan
from quartermart.plans import presence, refresh, warehouse
from quartermart.plans import visits as visit_plan
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import city_quarter
from quartermart.plans.leaderboards import top_attractions, top_cities
from quartermart.plans.portrait import user_portrait
from quartermart.plans.user_quarter import user_quarter
from quartermart.session import ensure_checkpoint_dir
from quartermart.sources import binding, raw, schemas, sinks
from quartermart.sources.buckets import write_bucketed
from quartermart.sources.raw import rename

Query = Callable[[SparkSession, str], DataFrame]

# Year range used by the single-operator year-filter check (a strict subset
# of the years present, so the filter has rows on both sides).
YEAR_FILTER_CHECK = (1997, 2000)


# --- inputs -------------------------------------------------------------------
#
# Input plans are built once per (session, directory) and reused by every
# query, as one warehouse run would: a DataFrame is an immutable plan, so
# sharing it shares no data.

_MEMO: dict[tuple[int, str], dict] = {}


def _memo(spark: SparkSession, d: str) -> dict:
    key = (id(spark), d)
    entry = _MEMO.get(key)
    if entry is None or entry.get("_spark") is not spark:
        entry = {"_spark": spark}
        _MEMO.clear()
        _MEMO[key] = entry
    return entry


def _cached(name: str, build: Callable[[SparkSession, str], object]):
    def get(spark, d):
        memo = _memo(spark, d)
        if name not in memo:
            memo[name] = build(spark, d)
        return memo[name]
    get.__name__ = name
    return get


ods_poi = _cached("ods_poi", lambda spark, d: rename(binding.raw_poi(spark, d), K.POI_HEADER_RENAMES))
ods_trip = _cached("ods_trip", lambda spark, d: rename(binding.raw_trip(spark, d), K.TRIP_HEADER_RENAMES))
ods_dirty = _cached("ods_dirty", lambda spark, d: rename(binding.dirty_trip(spark, d), K.TRIP_HEADER_RENAMES))
dim = _cached("dim", lambda spark, d: poi_plan.clean_poi(ods_poi(spark, d),
                                                         categories=binding.TEST_CATEGORY_RULES))
fact = _cached("fact", lambda spark, d: visit_plan.clean_visits(ods_trip(spark, d),
                                                                years=binding.TEST_YEAR_RANGE))


def uq(spark, d):
    return user_quarter(fact(spark, d), dim(spark, d))


def aq(spark, d):
    return attraction_quarter(fact(spark, d), dim(spark, d))


def cq(spark, d):
    return city_quarter(fact(spark, d), dim(spark, d))


def portrait(spark, d):
    return user_portrait(uq(spark, d))


# --- output normalisation -----------------------------------------------------

def normalize(df: DataFrame) -> DataFrame:
    """Integers -> bigint, arrays / maps -> sorted text; other types unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.ArrayType):
            c = array_text(c)
        elif isinstance(f.dataType, T.MapType):
            c = map_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


UQ_KEY = ["blog_id", "travel_year", "travel_quarter"]
AQ_KEY = ["poi_id", "travel_year", "travel_quarter"]
CQ_KEY = ["city", "region", "travel_year", "travel_quarter"]


def _pick(source: Callable, *cols: str) -> Query:
    def q(spark, d):
        return normalize(source(spark, d).select(*cols))
    return q


# --- single-operator and job queries ------------------------------------------

def q_raw_rename(spark, d):
    return normalize(ods_poi(spark, d))


def q_raw_rename_trip(spark, d):
    return normalize(ods_trip(spark, d))


def q_poi_clean(spark, d):
    return normalize(dim(spark, d))


def q_poi_bbox(spark, d):
    return normalize(poi_plan.prepared_poi(ods_poi(spark, d)).select("poi_id", "latitude", "longitude"))


def q_poi_region(spark, d):
    df = poi_plan.classify(poi_plan.prepared_poi(ods_poi(spark, d)), categories=binding.TEST_CATEGORY_RULES)
    return normalize(df.select("poi_id", "latitude", "longitude", "region"))


def q_poi_category(spark, d):
    df = poi_plan.classify(poi_plan.prepared_poi(ods_poi(spark, d)), categories=binding.TEST_CATEGORY_RULES)
    return normalize(df.select("poi_id", "label_zh", "category"))


def q_reject_null_region(spark, d):
    return normalize(poi_plan.rejected_regions(ods_poi(spark, d), categories=binding.TEST_CATEGORY_RULES))


def q_profile_bounds(spark, d):
    return normalize(profile.bounds(poi_plan.prepared_poi(ods_poi(spark, d)), ["latitude", "longitude"]))


def q_profile_labels(spark, d):
    return normalize(profile.frequency(poi_plan.prepared_poi(ods_poi(spark, d)), ["label_zh"], n=50))


def q_profile_category(spark, d):
    return normalize(profile.frequency(dim(spark, d), ["category"]))


def q_profile_region(spark, d):
    return normalize(profile.frequency(dim(spark, d), ["region"]))


def q_profile_years(spark, d):
    return normalize(visit_plan.year_profile(ods_trip(spark, d)))


def q_visits_dropna(spark, d):
    df = ods_dirty(spark, d).select("blog_id", "departure_date", "travel_partners", "visit_sequence")
    return normalize(clean.require(df, ["blog_id", "departure_date", "visit_sequence"]))


def q_partner_fill(spark, d):
    df = ods_trip(spark, d).select("blog_id", "departure_date", "travel_partners")
    return normalize(clean.fill(df, {"travel_partners": K.UNRECORDED_PARTNER}))


def q_reject_bad_dates(spark, d):
    return normalize(visit_plan.rejected_dates(ods_dirty(spark, d)))


def q_visits_dedup(spark, d):
    df = visit_plan.add_trip_id(visit_plan.dedupe_trips(visit_plan.prepared_trips(ods_dirty(spark, d))))
    return normalize(df.select("blog_id", "departure_date", "visit_sequence", "travel_partners", "trip_id",
                               "travel_date"))


def q_visits_year_range(spark, d):
    df = visit_plan.trips_in_years(ods_trip(spark, d), years=YEAR_FILTER_CHECK)
    return normalize(df.select("blog_id", "trip_id", "travel_date", "travel_year", "travel_month",
                               "travel_partners"))


def q_visits_exploded(spark, d):
    return normalize(visit_plan.clean_visits(ods_dirty(spark, d), years=binding.TEST_YEAR_RANGE))


def q_visits_clean(spark, d):
    return normalize(fact(spark, d))


def _visits_with_dim(how: str) -> Query:
    def q(spark, d):
        p = dim(spark, d).select("poi_id", "name", "city", "category", "region")
        return normalize(attach_dim(fact(spark, d), p, "poi_id", how=how))
    return q


def q_top50(spark, d):
    return normalize(top_attractions(aq(spark, d)))


def q_city_top10(spark, d):
    return normalize(top_cities(cq(spark, d)))


# --- paths that other callers get ----------------------------------------------

def q_poi_clean_dirty(spark, d):
    """The shipped region and category rules over POIs with every kind of dirt."""
    return normalize(poi_plan.clean_poi(rename(binding.dirty_poi(spark, d), K.POI_HEADER_RENAMES)))


def q_poi_rows_dirty(spark, d):
    """The same rows before ids are made unique: repeated ids stay."""
    return normalize(poi_plan.clean_poi(rename(binding.dirty_poi(spark, d), K.POI_HEADER_RENAMES), unique=False))


def q_reject_null_region_open(spark, d):
    """Region rules without a default leave POIs without a region."""
    rules = replace(DEFAULT_REGION_RULES, default=None)
    return normalize(poi_plan.rejected_regions(ods_poi(spark, d), rules, binding.TEST_CATEGORY_RULES))


def q_visits_clean_gappy(spark, d):
    """Null users and null visit lists are dropped."""
    return normalize(visit_plan.clean_visits(rename(binding.gappy_trip(spark, d), K.TRIP_HEADER_RENAMES), years=binding.TEST_YEAR_RANGE))


def q_attraction_ranks_range(spark, d):
    """The distributed form of ranking."""
    df = attraction_quarter(fact(spark, d), dim(spark, d), rank_form=RANGE)
    return normalize(df.select(*AQ_KEY, "user_rank_in_city", "user_rank_in_region", "user_rank_overall"))


def q_attraction_growth_strict(spark, d):
    """Growth against the adjacent calendar quarter only."""
    df = attraction_quarter(fact(spark, d), dim(spark, d), strict_growth=True)
    return normalize(df.select(*AQ_KEY, "user_cnt_growth_rate", "is_hot_rising"))


def q_top50_recomputed(spark, d):
    return normalize(top_attractions(aq(spark, d), recompute=True))


def q_user_quarter_shuffled(spark, d):
    """The user mart with a shuffled dimension join."""
    return normalize(user_quarter(fact(spark, d), dim(spark, d), broadcast=False))


# --- stores: what a reader gets from files that the tables were written to --------

def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def q_raw_mixed_headers(spark, d):
    """Raw CSV files with two orders of columns load by name."""
    path = _scratch(spark, "csv")
    binding.write_messy_csv(spark, d, path)
    return normalize(raw.read_trip_csv(spark, path))


def q_raw_rejects(spark, d):
    """Rows of raw CSV files that don't fit their header, with the reason."""
    path = _scratch(spark, "csv")
    binding.write_messy_csv(spark, d, path)
    return normalize(raw.scan_trip_csv(spark, path)[1].select("reason", "line"))


def q_read_after_failed_write(spark, d):
    """A write that breaks off leaves the table as it was."""
    root, name = _scratch(spark, "root"), "ods.trips"
    sinks.overwrite_table(schemas.conform(ods_trip(spark, d), schemas.ODS_TRIP), name, schemas.ODS_TRIP, root=root)
    broken = F.when(F.col("travel_partners") == K.SOLO, F.raise_error(F.lit("broken off"))).otherwise(F.lit("lost"))
    try:
        sinks.overwrite_table(ods_trip(spark, d).withColumn("travel_partners", broken), name, root=root)
    except Exception as e:  # the job's own error
        if "broken off" not in str(e):
            raise
    return normalize(sinks.read_table(spark, name, root))


def _refreshed(spark, d) -> warehouse.Config:
    """All layers after two loads, the second one by refresh."""
    cfg = warehouse.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE, root=_scratch(spark, "layers"))
    first, second = (rename(x, K.TRIP_HEADER_RENAMES) for x in binding.two_loads(spark, d, _write(spark)))
    warehouse.load_ods(spark, ods_poi(spark, d), first, cfg)
    warehouse.run(spark, cfg)
    refresh.start(spark, cfg)
    refresh.refresh(spark, second, cfg)
    return cfg


refreshed = _cached("refreshed", _refreshed)


def _refreshed_table(field: str) -> Query:
    def q(spark, d):
        cfg = refreshed(spark, d)
        return normalize(sinks.read_table(spark, getattr(cfg.tables, field), cfg.root))
    return q


# --- buckets, rules by words, top values by summaries -----------------------------

def _bucketed(spark, d, df: DataFrame, by: list[str], partition_by: list[str]) -> DataFrame:
    """``df`` as a table in 8 buckets below the shared checkpoint folder."""
    name = f"bucketed_{uuid.uuid4().hex}"
    write_bucketed(df, name, by, 8, partition_by=partition_by, home=_scratch(spark, name))
    return spark.table(name)


def _bucketed_mart(spark, d) -> DataFrame:
    visits = _bucketed(spark, d, fact(spark, d), warehouse.TRIP_BUCKETS, [])
    mart = user_quarter(visits, dim(spark, d), broadcast=BOUNDED)
    return _bucketed(spark, d, mart, warehouse.USER_BUCKETS, warehouse.QUARTER_PARTITION)


bucketed_mart = _cached("bucketed_mart", _bucketed_mart)


def q_user_quarter_bucketed(spark, d):
    """The user mart from visits in buckets of trips, read back from buckets of users."""
    return normalize(bucketed_mart(spark, d))


def q_user_portrait_bucketed(spark, d):
    """Portraits from a mart in buckets of users, without a shuffle."""
    return normalize(user_portrait(bucketed_mart(spark, d), clustered=True))


def q_poi_category_words(spark, d):
    """Categories by joining substrings of labels with the rules' words."""
    df = words.categories_by_words(poi_plan.prepared_poi(ods_poi(spark, d)), binding.TEST_CATEGORY_RULES)
    return normalize(df.select("poi_id", "label_zh", "category"))


def q_poi_category_words_dirty(spark, d):
    """The shipped category rules by words over POIs with every kind of dirt; repeated ids stay."""
    df = poi_plan.prepared_poi(rename(binding.dirty_poi(spark, d), K.POI_HEADER_RENAMES))
    return normalize(words.categories_by_words(df, DEFAULT_CATEGORY_RULES, broadcast=SPLIT).select("poi_id", "label_zh", "category"))


def q_profile_labels_summary(spark, d):
    """The most frequent labels from bounded summaries and exact counts of the candidates."""
    return normalize(top.top_frequency(poi_plan.prepared_poi(ods_poi(spark, d)), "label_zh", 50)[0])


def q_top_places_summary(spark, d):
    """The 50 places with most visits from bounded summaries and exact counts of the candidates."""
    return normalize(top.top_frequency(skewed(spark, d), "poi_id", 50)[0])


# --- counts from bitmaps, joins of heavy keys --------------------------------------

def _write(spark: SparkSession):
    """Writer of intermediate tables below the shared checkpoint folder."""
    def write(df: DataFrame, name: str) -> DataFrame:
        path = _scratch(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return write


def _place_state(spark, d) -> DataFrame:
    return _write(spark)(presence.place_state(presence.numbered(fact(spark, d), _write(spark))), "place_state")


place_state = _cached("place_state", _place_state)


def q_attraction_counts_bitmaps(spark, d):
    """Distinct users and trips by bitmaps, for places that the dimension has."""
    df = attach_dim(presence.attraction_counts(place_state(spark, d)), dim(spark, d).select("poi_id"), "poi_id", how="inner")
    return normalize(df.select(*AQ_KEY, "visit_user_cnt", "visit_trip_cnt", "visit_total_cnt"))


def q_city_counts_bitmaps(spark, d):
    """The city mart's counts from the places' bitmaps."""
    return normalize(presence.city_counts(place_state(spark, d), dim(spark, d)).drop("solo_trip_cnt"))


def q_attraction_year_bitmaps(spark, d):
    """Distinct users and trips of places over whole years, from the quarters' bitmaps."""
    return normalize(presence.counts_over(place_state(spark, d), ["poi_id", "travel_year"]))


skewed = _cached("skewed", lambda spark, d: binding.skewed_visits(fact(spark, d)))


def _skewed_with_dim(how: str) -> Query:
    def q(spark, d):
        cols = dim(spark, d).select("poi_id", "name", "city", "category", "region")
        return normalize(attach_dim(skewed(spark, d), cols, "poi_id", how=how, broadcast=SPLIT))
    return q


def q_user_quarter_split(spark, d):
    """The user mart over visits of which one place has a third, by a split join."""
    return normalize(user_quarter(skewed(spark, d), dim(spark, d), broadcast=SPLIT))


def queries() -> dict[str, Query]:
    return {
        "user_quarter_bucketed": q_user_quarter_bucketed,
        "user_portrait_bucketed": q_user_portrait_bucketed,
        "poi_category_words": q_poi_category_words,
        "poi_category_words_dirty": q_poi_category_words_dirty,
        "profile_labels_summary": q_profile_labels_summary,
        "top_places_summary": q_top_places_summary,
        "attraction_counts_bitmaps": q_attraction_counts_bitmaps,
        "city_counts_bitmaps": q_city_counts_bitmaps,
        "attraction_year_bitmaps": q_attraction_year_bitmaps,
        "skewed_left_poi_split": _skewed_with_dim("left"),
        "skewed_inner_poi_split": _skewed_with_dim("inner"),
        "user_quarter_split": q_user_quarter_split,
        "raw_mixed_headers": q_raw_mixed_headers,
        "raw_rejects": q_raw_rejects,
        "read_after_failed_write": q_read_after_failed_write,
        "refresh_visits": _refreshed_table("dwd_visit"),
        "refresh_user_quarter": _refreshed_table("dws_user"),
        "refresh_attraction_quarter": _refreshed_table("dws_attraction"),
        "refresh_city_quarter": _refreshed_table("dws_city"),
        "refresh_user_portrait": _refreshed_table("ads_portrait"),
        "poi_clean_dirty": q_poi_clean_dirty,
        "poi_rows_dirty": q_poi_rows_dirty,
        "reject_null_region_open": q_reject_null_region_open,
        "visits_clean_gappy": q_visits_clean_gappy,
        "attraction_ranks_range": q_attraction_ranks_range,
        "attraction_growth_strict": q_attraction_growth_strict,
        "top50_recomputed": q_top50_recomputed,
        "user_quarter_shuffled": q_user_quarter_shuffled,
        # sources and cleaning
        "raw_rename": q_raw_rename,
        "raw_rename_trip": q_raw_rename_trip,
        "poi_clean": q_poi_clean,
        "poi_bbox": q_poi_bbox,
        "poi_region": q_poi_region,
        "poi_category": q_poi_category,
        "reject_null_region": q_reject_null_region,
        "profile_bounds": q_profile_bounds,
        "profile_labels": q_profile_labels,
        "profile_category": q_profile_category,
        "profile_region": q_profile_region,
        "profile_years": q_profile_years,
        "visits_dropna": q_visits_dropna,
        "partner_fill": q_partner_fill,
        "reject_bad_dates": q_reject_bad_dates,
        "visits_dedup": q_visits_dedup,
        "visits_year_range": q_visits_year_range,
        "visits_exploded": q_visits_exploded,
        "visits_clean": q_visits_clean,
        # joins
        "visits_left_poi": _visits_with_dim("left"),
        "visits_inner_poi": _visits_with_dim("inner"),
        # user quarter mart
        "user_quarter_counts": _pick(uq, *UQ_KEY, "trip_total_cnt", "total_spot_cnt", "unique_city_cnt",
                                     "unique_category_cnt"),
        "user_quarter_category": _pick(uq, *UQ_KEY, "unique_category_cnt"),
        "user_quarter_cross_region": _pick(uq, *UQ_KEY, "cross_region_trip_cnt"),
        "user_quarter_solo": _pick(uq, *UQ_KEY, "solo_trip_ratio"),
        "user_quarter_dates": _pick(uq, *UQ_KEY, "first_trip_date", "last_trip_date"),
        "user_quarter_sets": _pick(uq, *UQ_KEY, "region_arr", "partner_arr"),
        "city_visit_map": _pick(uq, *UQ_KEY, "city_visit_map"),
        "category_visit_map": _pick(uq, *UQ_KEY, "cate_visit_map"),
        "top_city": _pick(uq, *UQ_KEY, "top_city"),
        "top_category": _pick(uq, *UQ_KEY, "top_category"),
        "peak_month": _pick(uq, *UQ_KEY, "peak_month"),
        "user_quarter_ratios": _pick(uq, *UQ_KEY, "avg_spot_per_trip", "avg_city_per_trip", "avg_trip_per_month"),
        "user_quarter_levels": _pick(uq, *UQ_KEY, "travel_level", "region_type"),
        "user_quarter": lambda spark, d: normalize(uq(spark, d)),
        # attraction mart
        "attraction_quarter_counts": _pick(aq, *AQ_KEY, "visit_user_cnt", "visit_trip_cnt", "visit_total_cnt"),
        "attraction_solo": _pick(aq, *AQ_KEY, "solo_user_ratio"),
        "attraction_ranks": _pick(aq, *AQ_KEY, "user_rank_in_city", "user_rank_in_region", "user_rank_overall"),
        "attraction_growth": _pick(aq, *AQ_KEY, "user_cnt_growth_rate", "is_hot_rising"),
        "attraction_quarter": lambda spark, d: normalize(aq(spark, d)),
        "top50_attractions": q_top50,
        # city mart
        "city_quarter_counts": _pick(cq, *CQ_KEY, "visit_user_cnt", "visit_trip_cnt", "visit_spot_cnt",
                                     "unique_attraction_cnt"),
        "city_quarter_features": _pick(cq, *CQ_KEY, "avg_spot_per_user"),
        "city_solo": _pick(cq, *CQ_KEY, "solo_user_ratio"),
        "city_ranks": _pick(cq, *CQ_KEY, "user_rank_in_region", "user_rank_overall"),
        "city_growth": _pick(cq, *CQ_KEY, "user_cnt_growth_rate", "is_hot_rising"),
        "city_quarter": lambda spark, d: normalize(cq(spark, d)),
        "city_top10": q_city_top10,
        # portrait
        "portrait_totals": _pick(portrait, "blog_id", "total_trips", "total_spots", "active_years",
                                 "first_active_year", "last_active_year"),
        "portrait_averages": _pick(portrait, "blog_id", "avg_spots_per_trip", "solo_trip_ratio"),
        "portrait_reach": _pick(portrait, "blog_id", "total_cities", "total_regions"),
        "favorite_city": _pick(portrait, "blog_id", "favorite_city"),
        "favorite_category": _pick(portrait, "blog_id", "favorite_category"),
        "portrait_levels": _pick(portrait, "blog_id", "travel_level", "region_type"),
        "user_portrait": lambda spark, d: normalize(portrait(spark, d)),
    }
