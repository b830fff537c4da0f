"""User x quarter wide table.

The original builds this from ten aggregates and eight joins on
(user, year, quarter). Here it is one scan, one dimension join and two shuffles:

1. Visits are counted per (user-quarter, trip, month, city, region, category,
   partner). The partial step combines map-side, and the key holds the trip, so a
   user-quarter with a large share of all visits is spread over many tasks. Counts
   and dates have fixed width, so this is a hash aggregate without collections.
2. The counted rows are dealt out by user-quarter. A trip is one user's day, so
   a user-quarter has at most 92 trips (times their places' cities and
   categories), however many visits it has. They are collected once, and all
   counts, sets and maps come from that one array, in steps linear in its length
   (times categories, which are as many as the rules).

Semantics kept from the original: unmatched POIs count as visits; a category
equal to "unclassified" (or null) is not a category; the category map is null
when no categorised visit exists. Decisions where the original was undefined:
city map keys are never null (unmatched visits are left out of the map, so a
quarter with no matched visit has an empty map and no range type); a trip's
partner is its smallest partner text; peak-month ties go to the earlier month;
all arrays are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.collect import top_keys
from quartermart.functions.metrics import quarter_level, quarter_of, quarter_range_type, ratio
from quartermart.operators.join import attach_dim
from quartermart.sources import schemas

U = ["blog_id", "travel_year", "travel_quarter"]


def joined_visits(visits: DataFrame, poi: DataFrame, broadcast: bool | str | None = None) -> DataFrame:
    """Visits LEFT JOIN POI (city, category, region), with the quarter; unmatched visits kept."""
    v = visits.select("blog_id", "trip_id", "travel_date", "travel_year", "travel_month",
                      "travel_partners", "poi_id").withColumn("travel_quarter", quarter_of("travel_date"))
    dim = poi.select("poi_id", "city", "category", "region")
    return attach_dim(v, dim, "poi_id", how="left", broadcast=broadcast)


def counted_visits(joined: DataFrame) -> DataFrame:
    """Step 1: equal visits of a trip with their number ``n``, dealt out by U."""
    return joined.groupBy(*U, "trip_id", "travel_month", "city", "region", "category", "travel_partners").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("travel_date").alias("dmin"),
        F.max("travel_date").alias("dmax"),
    ).repartition(*U)


def _distinct(col: str, field: str) -> Column:
    """Sorted distinct values of the text column ``field`` that are not null."""
    return F.sort_array(F.array_distinct(F.transform(F.filter(col, lambda r: r[field].isNotNull()), lambda r: r[field])))


def _pairs(col: str, of: str, first: str, second: str) -> Column:
    """Sorted pairs of two fields where ``of`` is not null. Equal pairs stay, as neighbours: Spark's ``array_distinct`` compares structs each with each."""
    return F.sort_array(F.transform(F.filter(col, lambda r: r[of].isNotNull()), lambda r: F.struct(r[first].alias(first), r[second].alias(second))))


def _firsts(pairs: str, field: str) -> Column:
    """``field`` of each distinct pair of a sorted array, in its order."""
    return F.transform(F.filter(pairs, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(pairs, i - 1))), lambda p: p[field])


def _trips(rows: Column) -> Column:
    return F.array_distinct(F.transform(rows, lambda r: r["trip_id"]))


def _starts(keys: str) -> Column:
    """Places at which a run of equal keys begins, in an array in which equal keys are neighbours."""
    at = F.when(F.size(keys) > 0, F.sequence(F.lit(0), F.size(keys) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, lambda i: (i == 0) | ~F.get(keys, i).eqNullSafe(F.get(keys, i - 1)))


def _run_length(starts: str, keys: str, i: Column, j: Column) -> Column:
    return F.coalesce(F.get(starts, j + 1), F.size(keys)) - i


def _sum_n(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0).cast("long"), lambda s, r: s + r["n"])


def quarter_metrics(rows: DataFrame, unclassified: str = K.UNCLASSIFIED) -> DataFrame:
    """Step 2: one row per U with every base metric, set and map, from ``counted_visits``."""
    entry = F.struct("trip_id", "travel_month", "city", "region", "category", "travel_partners", "n")
    u = rows.groupBy(*U).agg(
        F.sum("n").alias("total_spot_cnt"),
        F.min("dmin").alias("first_trip_date"),
        F.max("dmax").alias("last_trip_date"),
        F.collect_list(entry).alias("v"),
    )
    # one entry a (city, trip) and a (trip, region), ordered, so that equal cities and equal trips are neighbours;
    # each array is a column of its own before a lambda looks into it, so it is made once a row
    u = u.select(*u.columns, _pairs("v", "city", "city", "trip_id").alias("_city_pairs"), _pairs("v", "region", "trip_id", "region").alias("_region_pairs"))
    u = u.select(*u.columns,
                 _firsts("_city_pairs", "city").alias("_cities"),
                 _firsts("_region_pairs", "trip_id").alias("_region_trips"),
                 F.array_distinct(F.transform("v", lambda r: r["travel_month"])).alias("_months"),
                 _distinct("v", "category").alias("_categories"))
    u = u.select(*u.columns, _starts("_cities").alias("_city_starts"), _starts("_region_trips").alias("_trip_starts"))
    month = lambda m: F.struct(_sum_n(F.filter("v", lambda r: r["travel_month"].eqNullSafe(m))).alias("n"),
                               (-m).alias("minus"), m.alias("month"))
    category = lambda c: F.struct(c.alias("key"), _sum_n(F.filter("v", lambda r: r["category"] == c)).alias("value"))
    city = lambda i, j: F.struct(F.get("_cities", i).alias("key"),
                                 _run_length("_city_starts", "_cities", i, j).cast("long").alias("value"))
    several = F.filter("_trip_starts", lambda i, j: _run_length("_trip_starts", "_region_trips", i, j) >= 2)
    with_solo = _trips(F.filter("v", lambda r: r["travel_partners"] == K.SOLO))
    with_smaller = _trips(F.filter("v", lambda r: r["travel_partners"] < K.SOLO))
    classified = F.filter("_categories", lambda c: c != unclassified)
    return u.select(
        *U, "total_spot_cnt", "first_trip_date", "last_trip_date",
        F.size(_trips(F.col("v"))).alias("trip_total_cnt"),
        F.size(several).alias("cross_region_trip_cnt"),
        F.size(F.array_except(with_solo, with_smaller)).alias("solo_trip_cnt"),
        F.array_max(F.transform("_months", month))["month"].alias("peak_month"),
        _distinct("v", "region").alias("region_arr"),
        _distinct("v", "travel_partners").alias("partner_arr"),
        F.map_from_entries(F.transform("_city_starts", city)).alias("city_visit_map"),
        F.when(F.size(classified) > 0, F.map_from_entries(F.transform(classified, category))).alias("cate_visit_map"),
    )


def finish(df: DataFrame) -> DataFrame:
    """Counts from maps, ratios, labels, top keys; declared column order and types.

    One projection (a single analysis pass) instead of a chain of columns.
    """
    trips = F.col("trip_total_cnt")
    n_cities = F.size("city_visit_map")
    n_categories = F.coalesce(F.size("cate_visit_map"), F.lit(0))
    derived = {
        "travel_level": quarter_level(trips),
        "region_type": quarter_range_type(F.size("region_arr"), n_cities),
        "unique_city_cnt": n_cities,
        "unique_category_cnt": n_categories,
        "avg_spot_per_trip": ratio("total_spot_cnt", trips),
        "avg_city_per_trip": ratio(n_cities, trips),
        "avg_trip_per_month": F.when(trips > 0, F.round(trips / 3, K.RATIO_DIGITS)).otherwise(F.lit(0.0)),
        "top_city": top_keys("city_visit_map"),
        "top_category": top_keys("cate_visit_map"),
        "solo_trip_ratio": ratio("solo_trip_cnt", trips),
    }
    return df.select(*[(derived[f.name] if f.name in derived else F.col(f.name)).cast(f.dataType).alias(f.name)
                       for f in schemas.DWS_USER_QUARTER.fields])


def user_quarter(visits: DataFrame, poi: DataFrame, broadcast: bool | str | None = None,
                 unclassified: str = K.UNCLASSIFIED) -> DataFrame:
    """The user-quarter mart with the declared columns of ``DWS_USER_QUARTER``."""
    rows = counted_visits(joined_visits(visits, poi, broadcast))
    return finish(quarter_metrics(rows, unclassified))
