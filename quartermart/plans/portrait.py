"""Lifetime user portrait from the user-quarter mart.

One linear plan with a single shuffle: the mart is hash-partitioned by user
(a user has at most one mart row per quarter, so no key can hold more than
that many rows: this shuffle cannot be skewed), then every quarter row becomes
four rows, one a kind of entry (its year with the totals, its city counts, its
category counts, its regions), whose entries are exploded, summed per (user,
kind, key) and aggregated per user. No lambda runs for an entry.
Both aggregates run inside the user partitioning, without another exchange.
No branch reads the mart twice and no join is needed.

Averages are unweighted means over quarters of 4-digit ratios, computed in
exact integer arithmetic and rounded half-up to 2 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermart.functions.collect import keys_with_max
from quartermart.functions.metrics import exact_mean, lifetime_level, lifetime_range_type, scaled
from quartermart.sources import schemas

ENTRIES = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("cnt", T.LongType())]))
VALUE_FIELDS = ("cnt", "trips", "spots", "spt4", "solo4", "nq")


def portrait_entries(mart: DataFrame, clustered: bool = False) -> DataFrame:
    """(blog_id, kind, key) -> summed values; kinds Y(ear), C(ity), K (category), R(egion).

    ``clustered``: the mart is stored in buckets of blog_id, so it isn't dealt out again.
    """
    year = F.array(F.struct(F.col("travel_year").cast("string"), F.lit(None).cast("long")))
    regions = F.arrays_zip(F.col("region_arr"), F.array_repeat(F.lit(1).cast("long"), F.size("region_arr")))
    kinds = {"Y": year, "C": F.map_entries("city_visit_map"), "K": F.map_entries("cate_visit_map"), "R": regions}
    of_year = {"trips": F.col("trip_total_cnt"), "spots": F.col("total_spot_cnt"), "spt4": scaled("avg_spot_per_trip"),
               "solo4": scaled("solo_trip_ratio"), "nq": F.lit(1)}
    by_user = mart if clustered else mart.repartition("blog_id")
    totals = by_user.select("blog_id", *[v.cast("long").alias(f"_{c}") for c, v in of_year.items()],
                            F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.cast(ENTRIES).alias("entries")) for k, v in kinds.items()])).alias("k"))
    e = totals.select("blog_id", F.col("k.kind").alias("kind"), *[F.when(F.col("k.kind") == "Y", F.col(f"_{c}")).alias(c) for c in of_year],
                      F.explode("k.entries").alias("e")).select("*", "e.key", "e.cnt")
    return e.groupBy("blog_id", "kind", "key").agg(
        *[F.sum(c).alias(c) for c in VALUE_FIELDS])


def user_portrait(mart: DataFrame, clustered: bool = False) -> DataFrame:
    """The portrait with the declared columns of ``ADS_USER_PORTRAIT``."""
    e = portrait_entries(mart, clustered)
    kind = F.col("kind")
    is_y, is_c, is_k, is_r = kind == "Y", kind == "C", kind == "K", kind == "R"

    def entries(cond: Column) -> Column:
        return F.collect_list(F.when(cond, F.struct(F.col("cnt").alias("value"), F.col("key").alias("key"))))

    u = e.groupBy("blog_id").agg(
        F.sum(F.when(is_y, F.col("trips"))).alias("total_trips"),
        F.sum(F.when(is_y, F.col("spots"))).alias("total_spots"),
        F.count_if(is_c).alias("_n_city"),
        F.count_if(is_r).alias("_n_region"),
        F.count_if(is_y).alias("active_years"),
        F.min(F.when(is_y, F.col("key").cast("int"))).alias("first_active_year"),
        F.max(F.when(is_y, F.col("key").cast("int"))).alias("last_active_year"),
        F.sum(F.when(is_y, F.col("spt4"))).alias("_spt4"),
        F.sum(F.when(is_y, F.col("solo4"))).alias("_solo4"),
        F.sum(F.when(is_y, F.col("nq"))).alias("_nq"),
        entries(is_c).alias("_cities"),
        entries(is_k).alias("_cats"),
    )
    n_city, n_region = F.col("_n_city"), F.col("_n_region")
    total_cities = F.when(n_city > 0, n_city)
    total_regions = F.when(n_region > 0, n_region)
    derived = {
        "total_cities": total_cities,
        "total_regions": total_regions,
        "avg_spots_per_trip": exact_mean("_spt4", "_nq"),
        "solo_trip_ratio": exact_mean("_solo4", "_nq"),
        "favorite_city": F.when(F.size("_cities") > 0, keys_with_max(F.col("_cities"))),
        "favorite_category": F.when(F.size("_cats") > 0, keys_with_max(F.col("_cats"))),
        "travel_level": lifetime_level("total_trips", "active_years"),
        "region_type": lifetime_range_type(total_regions, total_cities),
    }
    return u.select(*[(derived[f.name] if f.name in derived else F.col(f.name)).cast(f.dataType).alias(f.name)
                      for f in schemas.ADS_USER_PORTRAIT.fields])

