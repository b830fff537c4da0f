"""Visit fact cleaning (raw trips -> one row per visited POI of a trip).

Order of work, chosen so the cheap filters run before the only shuffle:
required columns -> partner fill -> date parse -> year range -> dedupe of raw
copies (the shuffle; partial aggregation combines copies map-side) -> trip id
-> explode of the visit list.

The year filter runs before the dedupe (the original ran it after): the year
is a function of the departure date, which is a dedupe key, so the result is
the same and the dedupe sees fewer rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.operators import clean
from quartermart.sources.buckets import dealt

VISIT_COLUMNS = ["blog_id", "trip_id", "travel_date", "travel_year", "travel_month", "travel_partners", "poi_id"]
DEDUPE_KEYS = ["blog_id", "departure_date", "visit_sequence"]


def prepared_trips(ods_trip: DataFrame, pattern: str = K.DEPARTURE_DATE_PATTERN,
                   partner_fill: str = K.UNRECORDED_PARTNER) -> DataFrame:
    """Required columns present, partner filled, date parsed (null when bad)."""
    df = ods_trip.select("blog_id", "departure_date", "travel_partners", "visit_sequence")
    df = clean.require(df, ["blog_id", "departure_date", "visit_sequence"])
    df = clean.fill(df, {"travel_partners": partner_fill})
    df = clean.parse_date(df, "departure_date", "travel_date", pattern)
    return clean.add_year_month(df, "travel_date")


def rejected_dates(ods_trip: DataFrame, pattern: str = K.DEPARTURE_DATE_PATTERN) -> DataFrame:
    """Raw rows whose departure date does not parse (the reject report)."""
    return clean.rejected(prepared_trips(ods_trip, pattern), "travel_date", ["departure_date"])


def dedupe_trips(df: DataFrame) -> DataFrame:
    """One row per (user, departure text, visit list); the smallest partner text wins."""
    return clean.dedupe(df, DEDUPE_KEYS, smallest=["travel_partners"],
                        carry=["travel_date", "travel_year", "travel_month"])


def add_trip_id(df: DataFrame) -> DataFrame:
    """Trip id = ``user_departureText``: raw rows of one user and date are one trip."""
    return df.withColumn("trip_id", F.concat_ws(K.TRIP_ID_SEPARATOR, "blog_id", "departure_date"))


def trips_in_years(ods_trip: DataFrame, years: tuple[int, int] = K.YEAR_RANGE,
                   pattern: str = K.DEPARTURE_DATE_PATTERN) -> DataFrame:
    """Deduplicated raw trips whose year is in ``[years[0], years[1])``."""
    df = prepared_trips(ods_trip, pattern)
    df = clean.in_range(df, {"travel_year": years}, upper_inclusive=False)
    return add_trip_id(dedupe_trips(df))


def clean_visits(ods_trip: DataFrame, years: tuple[int, int] = K.YEAR_RANGE,
                 pattern: str = K.DEPARTURE_DATE_PATTERN, cluster_by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """The visit fact, columns :data:`VISIT_COLUMNS`.

    ``cluster_by``: trip columns to rebalance by for a partitioned write; done
    before the visit lists are exploded, so trips are moved and not visits.
    With ``buckets``, trips are dealt into that many buckets of ``cluster_by``.
    """
    trips = trips_in_years(ods_trip, years, pattern)
    if cluster_by:
        trips = dealt(trips, cluster_by, buckets) if buckets else trips.hint("rebalance", *cluster_by)
    exploded = clean.explode_list(trips.select(*VISIT_COLUMNS[:-1], "visit_sequence"),
                                  "visit_sequence", "poi_id", K.LIST_SEPARATOR)
    return exploded.select(*VISIT_COLUMNS)


def year_profile(ods_trip: DataFrame, pattern: str = K.DEPARTURE_DATE_PATTERN) -> DataFrame:
    """Deduplicated raw trips per year, before the year filter (a quality report)."""
    deduped = dedupe_trips(prepared_trips(ods_trip, pattern))
    return (deduped.groupBy("travel_year").agg(F.count(F.lit(1)).alias("count"))
                   .orderBy("travel_year"))
