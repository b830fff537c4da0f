"""Top-N leaderboards per quarter from the popularity marts.

The marts already carry ``user_rank_overall`` (trip count descending with a
unique tie-break), so a leaderboard is a filter on it: no window, no shuffle.
``recompute=True`` ranks again with a group limit instead, for a mart table
written without ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.functions.metrics import quarter_label
from quartermart.operators.ranking import top_n
from quartermart.sources import schemas

QUARTER = ["travel_year", "travel_quarter"]


def _ranked(mart: DataFrame, n: int, tiebreak: list[str], recompute: bool) -> DataFrame:
    if recompute:
        return top_n(mart, QUARTER, "visit_trip_cnt", n, tiebreak, rank_col="rank")
    return mart.filter(F.col("user_rank_overall") <= n).withColumn("rank", F.col("user_rank_overall"))


def top_attractions(mart: DataFrame, n: int = K.TOP_ATTRACTIONS, recompute: bool = False) -> DataFrame:
    """The ``n`` attractions with most trips per quarter, ordered by (quarter, rank)."""
    df = _ranked(mart, n, ["poi_id"], recompute)
    df = df.withColumn("year_quarter", quarter_label("travel_year", "travel_quarter"))
    return schemas.conform(df, schemas.ADS_TOP_ATTRACTIONS).orderBy("year_quarter", "rank")


def top_cities(mart: DataFrame, n: int = K.TOP_CITIES, recompute: bool = False) -> DataFrame:
    """The ``n`` (city, region) pairs with most trips per quarter, ordered by (quarter, rank)."""
    df = _ranked(mart, n, ["city", "region"], recompute)
    df = df.withColumn("year_quarter", quarter_label("travel_year", "travel_quarter"))
    return schemas.conform(df, schemas.ADS_CITY_TOP).orderBy("year_quarter", "rank")
