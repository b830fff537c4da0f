"""Distinct users and trips of places from bitmaps; cities, regions and years from those of their places.

``numbered`` writes the visits with numbers of users and trips.
``place_state`` reduces them to one row a (place, quarter, kind, word of bits), the only
pass over visits. All counts of the attraction mart and of the city mart, and
distinct users over any longer time, come from that table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.metrics import quarter_of
from quartermart.operators import bitmaps
from quartermart.operators.join import attach_dim

QUARTER = ["travel_year", "travel_quarter"]
PLACE = ["poi_id", *QUARTER]
SUMS = ["visit_total_cnt", "trip_row_cnt", "solo_trip_cnt"]
USERS, TRIPS = "user", "trip"

#: Writes a frame as a table under a name and returns it read back.
Write = Callable[[DataFrame, str], DataFrame]


def numbered(visits: DataFrame, write: Write) -> DataFrame:
    """The visits with ``user_no`` and ``trip_no``. Trips are numbered by quarter, so a quarter's trips share words."""
    v = write(visits.withColumn("travel_quarter", quarter_of("travel_date")), "quarter_visits")     # read three times below
    users = write(bitmaps.number(v, "blog_id", "user_no"), "user_numbers")
    trips = write(bitmaps.number(v, "trip_id", "trip_no", order=QUARTER), "trip_numbers")
    return write(v.join(users, "blog_id", "left").join(trips, "trip_id", "left"), "numbered_visits")


def place_state(visits: DataFrame) -> DataFrame:
    """(poi_id, year, quarter, kind, bucket): bits of users and trips, sums of visits."""
    sums = {"visit_total_cnt": F.lit(1), "trip_row_cnt": F.col("trip_id").isNotNull().cast("int"),
            "solo_trip_cnt": F.coalesce((F.col("travel_partners") == K.SOLO).cast("int"), F.lit(0))}
    return bitmaps.presence(visits, PLACE, {USERS: "user_no", TRIPS: "trip_no"}, sums)


def attraction_counts(state: DataFrame) -> DataFrame:
    """As ``plans.attraction_quarter.attraction_counts``."""
    df = bitmaps.counts(state, PLACE, {USERS: "visit_user_cnt", TRIPS: "visit_trip_cnt"}, SUMS)
    return df.select(*PLACE, "visit_user_cnt", "visit_trip_cnt", "visit_total_cnt", "solo_trip_cnt")


def city_counts(state: DataFrame, poi: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """As ``plans.city_quarter.city_counts``, without the visits: a place is in one city."""
    group = ["city", "region", *QUARTER]
    users = state.where(F.col("kind") != TRIPS)     # trips are visit rows here
    placed = attach_dim(users, poi.select("poi_id", "city", "region"), "poi_id", how="inner", broadcast=broadcast)
    placed = placed.withColumn("places", (F.col("kind") == "rows").cast("int"))
    sums = [*SUMS, "places"]
    df = bitmaps.counts(bitmaps.merged(placed, group, sums), group, {USERS: "visit_user_cnt"}, sums)
    return df.select(*group, "visit_user_cnt", F.col("trip_row_cnt").alias("visit_trip_cnt"), F.col("visit_total_cnt").alias("visit_spot_cnt"),
                     F.col("places").alias("unique_attraction_cnt"), "solo_trip_cnt")


def counts_over(state: DataFrame, group: Sequence[str]) -> DataFrame:
    """Distinct users, distinct trips and visits of any coarser group of a place's quarters, such as its years."""
    df = bitmaps.counts(bitmaps.merged(state, group, SUMS), group, {USERS: "visit_user_cnt", TRIPS: "visit_trip_cnt"}, SUMS)
    return df.select(*group, "visit_user_cnt", "visit_trip_cnt", "visit_total_cnt")
