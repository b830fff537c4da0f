"""Attraction x quarter popularity mart.

Plan: the fact is aggregated by (poi_id, year, quarter) *before* it meets the
dimension. Every dimension attribute is a function of ``poi_id`` (the
dimension is unique by id), so the inner join on the aggregated rows gives the
same rows as joining first, but the join input is one row per POI-quarter
instead of one row per visit, and the fact is never shuffled for a join.

Users and trips become distinct by a plain grouping each, keyed by (POI,
quarter, user) and by (POI, quarter, trip), so a POI-quarter holding a large
share of all visits is still spread over many tasks and combined map-side. They
are two stages: a task holds the users or the trips of its rows, not both as
with Catalyst's Expand for two distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.metrics import quarter_of, ratio
from quartermart.operators.growth import growth
from quartermart.operators.join import attach_dim
from quartermart.operators.ranking import WINDOW, rank_in
from quartermart.sources import schemas

QUARTER = ["travel_year", "travel_quarter"]
DIM_COLUMNS = ["name", "city", "category", "region"]
RANK_SCOPES = {
    "user_rank_overall": QUARTER,
    "user_rank_in_region": ["region", *QUARTER],
    "user_rank_in_city": ["city", *QUARTER],
}


def with_quarter(visits: DataFrame) -> DataFrame:
    return visits.withColumn("travel_quarter", quarter_of("travel_date"))


def attraction_counts(visits: DataFrame) -> DataFrame:
    """Per (poi_id, year, quarter): distinct users, distinct trips, visits, solo visits."""
    v = with_quarter(visits)
    place, solo = ["poi_id", *QUARTER], F.coalesce(F.col("travel_partners") == K.SOLO, F.lit(False))

    def parts(who: str, counted: Column, users: Column, trips: Column, solos: Column) -> DataFrame:
        """Counts from one row a place, quarter and ``who``; ``n``: the visits that are ``counted``."""
        return v.groupBy(*place, who).agg(F.count_if(counted).alias("n")).groupBy(*place).agg(
            users.alias("visit_user_cnt"), trips.alias("visit_trip_cnt"), F.sum("n").alias("visit_total_cnt"), solos.alias("solo_trip_cnt"))

    # each half counts its part of the visits, so both read the same columns of plans that end in a shuffle, which run once
    none = F.sum(F.lit(0).cast("long"))
    by_user = parts("blog_id", solo, F.count("blog_id"), none, F.sum("n"))
    by_trip = parts("trip_id", ~solo, none, F.count("trip_id"), none)
    return by_user.unionByName(by_trip).groupBy(*place).agg(
        *[F.sum(c).alias(c) for c in ("visit_user_cnt", "visit_trip_cnt", "visit_total_cnt", "solo_trip_cnt")])


def attraction_quarter(visits: DataFrame, poi: DataFrame, broadcast: bool | None = None,
                       strict_growth: bool = False, rank_form: str = WINDOW) -> DataFrame:
    """The attraction mart with the declared columns of ``DWS_ATTRACTION_QUARTER``.

    solo_user_ratio = solo *visits* / distinct trips (can exceed 1, as in the
    original); growth compares distinct users with the previous present quarter.

    A rank scope holds at most one row per POI; ``rank_form`` says how it is
    ranked (see ``operators.ranking``).
    """
    counts = attraction_counts(visits)
    dim = poi.select("poi_id", *DIM_COLUMNS)
    df = attach_dim(counts, dim, "poi_id", how="inner", broadcast=broadcast)
    df = rank_in(df, RANK_SCOPES, by="visit_trip_cnt", tiebreak=["poi_id"], form=rank_form)
    df = df.withColumn("solo_user_ratio", ratio("solo_trip_cnt", "visit_trip_cnt"))
    df = growth(df, ["poi_id"], "visit_user_cnt", strict=strict_growth)
    return schemas.conform(df, schemas.DWS_ATTRACTION_QUARTER)
