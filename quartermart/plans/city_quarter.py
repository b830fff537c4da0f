"""City x quarter popularity mart, keyed by (city, region).

A city name can fall in two regions (regions come from coordinates), so the
key is (city, region) everywhere, including the growth window; joining the
growth back on city alone would multiply rows.

Visits are first reduced to one row a (poi, quarter) with its visit and solo
counts and one a (poi, quarter, user), map-side combined and keyed by the user
too, so a hot POI is spread; only that reduced frame meets the dimension. A POI
is in one city (the dimension is unique by id), so its row counts as one place
and needs no distinct count; users become distinct by a plain grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.metrics import floor_ratio, quarter_of, ratio
from quartermart.operators.growth import growth
from quartermart.operators.join import attach_dim
from quartermart.operators.ranking import WINDOW, rank_in
from quartermart.sources import schemas

QUARTER = ["travel_year", "travel_quarter"]
CITY = ["city", "region"]
RANK_SCOPES = {
    "user_rank_overall": QUARTER,
    "user_rank_in_region": ["region", *QUARTER],
}


def city_counts(visits: DataFrame, poi: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Per (city, region, year, quarter): users, trips (= visit rows), visits, POIs, solo visits."""
    v = visits.withColumn("travel_quarter", quarter_of("travel_date"))
    dim = poi.select("poi_id", *CITY)
    entries = F.array(F.struct(F.lit(False).alias("is_user"), F.lit(None).cast("string").alias("user")),
                      F.struct(F.lit(True).alias("is_user"), F.col("blog_id").cast("string").alias("user")))
    e = v.select("poi_id", *QUARTER, "trip_id", "travel_partners", F.explode(entries).alias("e")).select("*", "e.is_user", "e.user")
    of_place = ~F.col("is_user")
    reduced = e.where(of_place | F.col("user").isNotNull()).groupBy("poi_id", *QUARTER, "is_user", "user").agg(
        F.count_if(of_place & F.col("trip_id").isNotNull()).alias("n_trip"),
        F.count_if(of_place).alias("n"),
        F.count_if(of_place & (F.col("travel_partners") == K.SOLO)).alias("n_solo"),
    )
    j = attach_dim(reduced, dim, "poi_id", how="inner", broadcast=broadcast)
    users = j.groupBy(*CITY, *QUARTER, "is_user", "user").agg(
        F.count(F.lit(1)).alias("places"), *[F.sum(c).alias(c) for c in ("n_trip", "n", "n_solo")])
    return users.groupBy(*CITY, *QUARTER).agg(
        F.count_if(F.col("is_user")).alias("visit_user_cnt"),
        F.sum("n_trip").alias("visit_trip_cnt"),
        F.sum("n").alias("visit_spot_cnt"),
        F.sum(F.when(of_place, F.col("places"))).alias("unique_attraction_cnt"),
        F.sum("n_solo").alias("solo_trip_cnt"),
    )


def city_quarter(visits: DataFrame, poi: DataFrame, broadcast: bool | None = None,
                 strict_growth: bool = False, rank_form: str = WINDOW) -> DataFrame:
    """The city mart with the declared columns of ``DWS_CITY_QUARTER``.

    avg_spot_per_user = floor(visits / users); solo_user_ratio = solo visits /
    visit rows; growth compares ``visit_trip_cnt`` (despite the column name,
    as in the original) with the previous present quarter of the same city.
    A rank scope holds at most one row per (city, region); ``rank_form`` says
    how it is ranked (see ``operators.ranking``).
    """
    df = city_counts(visits, poi, broadcast)
    df = (df.withColumn("avg_spot_per_user", floor_ratio("visit_spot_cnt", "visit_user_cnt"))
            .withColumn("solo_user_ratio", ratio("solo_trip_cnt", "visit_trip_cnt")))
    df = rank_in(df, RANK_SCOPES, by="visit_trip_cnt", tiebreak=["city", "region"], form=rank_form)
    df = growth(df, CITY, "visit_trip_cnt", strict=strict_growth)
    return schemas.conform(df, schemas.DWS_CITY_QUARTER)
