"""Declared schemas per layer: the name/type contract checked before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L, I, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()
ARR = T.ArrayType(T.StringType())
CNT_MAP = T.MapType(T.StringType(), T.LongType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_POI_CSV = _schema(*[(h, S) for h in (
    "Encrypted_ID", "Name_ZH", "Name_EN", "City_ZH", "City_EN",
    "Latitude_GCJ02", "Longitude_GCJ02", "Label_ZH", "Label_EN")])
RAW_TRIP_CSV = _schema(*[(h, S) for h in (
    "Anonymized_Blog_ID", "Retrieval_Date", "Departure_Date", "Travel_Partners", "Visit_Sequence")])

ODS_POI = _schema(*[(c, S) for c in (
    "poi_id", "name_zh", "name_en", "city_zh", "city_en", "latitude", "longitude", "label_zh", "label_en")])
ODS_TRIP = _schema(*[(c, S) for c in (
    "blog_id", "retrieval_date", "departure_date", "travel_partners", "visit_sequence")])

ODS_REJECT = _schema(("source", S), ("file", S), ("reason", S), ("line", S))

DWD_POI = _schema(("poi_id", S), ("name", S), ("city", S), ("latitude", D), ("longitude", D),
                  ("label", ARR), ("category", S), ("region", S))
DWD_TRIP = _schema(("blog_id", S), ("departure_date", S), ("visit_sequence", S), ("travel_partners", S),
                   ("travel_date", DT), ("travel_year", I), ("travel_month", I))
DWD_VISIT = _schema(("blog_id", S), ("trip_id", S), ("travel_date", DT), ("travel_year", I),
                    ("travel_month", I), ("travel_partners", S), ("poi_id", S))

DWS_USER_QUARTER = _schema(
    ("blog_id", S), ("travel_level", S), ("region_type", S),
    ("trip_total_cnt", L), ("total_spot_cnt", L), ("unique_city_cnt", L),
    ("unique_category_cnt", L), ("cross_region_trip_cnt", L),
    ("avg_spot_per_trip", D), ("avg_city_per_trip", D), ("avg_trip_per_month", D),
    ("region_arr", ARR), ("partner_arr", ARR), ("top_city", ARR), ("top_category", ARR),
    ("solo_trip_ratio", D), ("city_visit_map", CNT_MAP), ("cate_visit_map", CNT_MAP),
    ("peak_month", I), ("first_trip_date", DT), ("last_trip_date", DT),
    ("travel_year", I), ("travel_quarter", I))

DWS_ATTRACTION_QUARTER = _schema(
    ("poi_id", S), ("name", S), ("city", S), ("category", S), ("region", S),
    ("visit_user_cnt", L), ("visit_trip_cnt", L), ("visit_total_cnt", L),
    ("user_rank_in_city", I), ("user_rank_in_region", I), ("user_rank_overall", I),
    ("solo_user_ratio", D), ("user_cnt_growth_rate", D), ("is_hot_rising", S),
    ("travel_year", I), ("travel_quarter", I))

DWS_CITY_QUARTER = _schema(
    ("city", S), ("region", S),
    ("visit_user_cnt", L), ("visit_trip_cnt", L), ("visit_spot_cnt", L), ("unique_attraction_cnt", L),
    ("avg_spot_per_user", L), ("solo_user_ratio", D),
    ("user_rank_in_region", I), ("user_rank_overall", I),
    ("user_cnt_growth_rate", D), ("is_hot_rising", S),
    ("travel_year", I), ("travel_quarter", I))

ADS_USER_PORTRAIT = _schema(
    ("blog_id", S), ("total_trips", L), ("total_spots", L), ("total_cities", L), ("total_regions", L),
    ("active_years", L), ("first_active_year", I), ("last_active_year", I),
    ("avg_spots_per_trip", D), ("solo_trip_ratio", D),
    ("favorite_city", ARR), ("favorite_category", ARR), ("travel_level", S), ("region_type", S))

ADS_TOP_ATTRACTIONS = _schema(
    ("year_quarter", S), ("poi_id", S), ("name", S), ("city", S), ("category", S), ("region", S),
    ("visit_user_cnt", L), ("visit_trip_cnt", L), ("rank", I), ("is_hot_rising", S),
    ("user_cnt_growth_rate", D))

ADS_CITY_TOP = _schema(
    ("year_quarter", S), ("city", S), ("region", S), ("visit_user_cnt", L), ("visit_trip_cnt", L),
    ("unique_attraction_cnt", L), ("avg_spot_per_user", L), ("rank", I), ("is_hot_rising", S))


#: What the columns of the layer tables mean, by name; written as their comments.
COMMENTS = {
    "blog_id": "anonymous user", "trip_id": "user and departure date", "poi_id": "place", "name": "name of the place",
    "city": "city of the place", "region": "region by coordinates", "category": "category by label rules", "label": "labels of the place",
    "latitude": "degrees north", "longitude": "degrees east", "travel_date": "departure date", "travel_year": "year of departure",
    "travel_month": "month of departure", "travel_quarter": "quarter of departure", "year_quarter": "year and quarter, as 2020Q1",
    "travel_partners": "with whom the user travels", "travel_level": "how often the user travels", "region_type": "how far the user travels",
    "trip_total_cnt": "trips", "total_spot_cnt": "visits", "unique_city_cnt": "distinct cities", "unique_category_cnt": "distinct categories",
    "cross_region_trip_cnt": "trips to two regions or more", "avg_spot_per_trip": "visits a trip", "avg_city_per_trip": "cities a trip",
    "avg_trip_per_month": "trips a month", "region_arr": "distinct regions", "partner_arr": "distinct partners",
    "top_city": "cities with most trips, ties kept", "top_category": "categories with most visits, ties kept",
    "solo_trip_ratio": "share of trips alone", "city_visit_map": "trips to each city", "cate_visit_map": "visits of each category",
    "peak_month": "month with most visits", "first_trip_date": "first departure", "last_trip_date": "last departure",
    "visit_user_cnt": "distinct users", "visit_trip_cnt": "trips", "visit_total_cnt": "visits", "visit_spot_cnt": "visits",
    "unique_attraction_cnt": "distinct places", "avg_spot_per_user": "visits a user, rounded down", "solo_user_ratio": "visits alone over trips",
    "user_rank_in_city": "rank by trips in the city", "user_rank_in_region": "rank by trips in the region",
    "user_rank_overall": "rank by trips in the quarter", "user_cnt_growth_rate": "growth against the quarter before",
    "is_hot_rising": "whether the growth is above the threshold", "rank": "rank by trips in the quarter",
    "total_trips": "trips in all years", "total_spots": "visits in all years", "total_cities": "distinct cities in all years",
    "total_regions": "distinct regions in all years", "active_years": "years with a trip", "first_active_year": "first year with a trip",
    "last_active_year": "last year with a trip", "avg_spots_per_trip": "mean of the quarters' visits a trip",
    "favorite_city": "cities with most trips in all years", "favorite_category": "categories with most visits in all years",
}


def commented(df: DataFrame) -> DataFrame:
    """``df`` with the comments of its columns as metadata, which Parquet files and catalog tables keep."""
    for f in df.schema.fields:
        if f.name in COMMENTS:
            df = df.withMetadata(f.name, {"comment": COMMENTS[f.name]})
    return df


class SchemaMismatch(ValueError):
    pass


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise unless ``df`` has exactly the declared column names, order and types
    (nullability is not part of the contract)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if got != want:
        raise SchemaMismatch(f"schema mismatch:\n got  {got}\n want {want}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the declared schema (names must exist)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
