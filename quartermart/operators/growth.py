"""Quarter-over-quarter growth and the rising flag (lag on the same frame, no self join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermart.functions import constants as K


def growth(df: DataFrame, entity: Sequence[str], metric: str,
           year: str = "travel_year", quarter: str = "travel_quarter",
           rate_col: str = "user_cnt_growth_rate", flag_col: str = "is_hot_rising",
           threshold: float = K.RISING_THRESHOLD, strict: bool = False,
           digits: int = K.RATIO_DIGITS) -> DataFrame:
    """Compare ``metric`` with the previous row of the same entity.

    "Previous" is the previous quarter *present* for the entity, as in the
    original warehouse. With ``strict=True`` only the immediately preceding
    calendar quarter counts; a gap is reported as no previous data.

    rate = round((m - prev) / prev, digits) if prev > 0 else 0
    flag = no-previous | yes if rate > threshold | no
    The window partitions by entity, so each partition holds at most one row
    per quarter of that entity.
    """
    w = Window.partitionBy(*entity).orderBy(F.col(year), F.col(quarter))
    prev = F.lag(F.col(metric), 1).over(w)
    if strict:
        idx = F.col(year) * 4 + F.col(quarter)
        prev_idx = F.lag(idx, 1).over(w)
        prev = F.when(idx - prev_idx == 1, prev)
    out = df.withColumn("_prev", prev)
    p, m = F.col("_prev"), F.col(metric)
    rate = F.when(p.isNotNull() & (p > 0), F.round((m - p) / p, digits)).otherwise(F.lit(0.0))
    out = out.withColumn(rate_col, rate.cast("double"))
    flag = (F.when(p.isNull(), K.RISING_NO_PREVIOUS)
             .when(F.col(rate_col) > threshold, K.RISING_YES)
             .otherwise(K.RISING_NO))
    return out.withColumn(flag_col, flag).drop("_prev")
