"""Scalar metric columns: quarters, safe ratios, labels, exact rounded means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermart.functions import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def quarter_of(date_col: str | Column) -> Column:
    """Calendar quarter 1..4 (same as ceil(month / 3))."""
    return F.quarter(_c(date_col))


def quarter_label(year: str | Column, quarter: str | Column) -> Column:
    """``2020Q1``."""
    return F.concat(_c(year).cast("string"), F.lit("Q"), _c(quarter).cast("string"))


def ratio(num: str | Column, den: str | Column, digits: int = K.RATIO_DIGITS) -> Column:
    """``round(num / den, digits)`` when ``den > 0`` else 0, as double."""
    n, d = _c(num), _c(den)
    return (F.when(d > 0, F.round(n / d, digits)).otherwise(F.lit(0.0))).cast("double")


def floor_ratio(num: str | Column, den: str | Column) -> Column:
    """``floor(num / den)`` when ``den > 0`` else 0, as bigint."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, F.floor(n / d)).otherwise(F.lit(0)).cast("long")


def scaled(x: str | Column, digits: int = K.RATIO_DIGITS) -> Column:
    """A ratio already rounded to ``digits`` as an exact integer of 10^-digits units."""
    return F.round(_c(x) * (10 ** digits)).cast("long")


def exact_mean(scaled_sum: str | Column, count: str | Column,
               scale_digits: int = K.RATIO_DIGITS, digits: int = K.PORTRAIT_DIGITS) -> Column:
    """Mean of non-negative fixed-point values, rounded half-up to ``digits``.

    ``scaled_sum`` is a sum of values in 10^-scale_digits units and ``count``
    the number of values. Integer arithmetic makes the result independent of
    summation order, so it is the same on every run and on every engine.
    """
    s, c = _c(scaled_sum).cast("long"), _c(count).cast("long")
    unit = 10 ** (scale_digits - digits)
    # round_half_up(s / (c * unit)) = floor((2 s + c unit) / (2 c unit))
    q = F.floor((s * 2 + c * unit) / (c * unit * 2))
    return F.when(c > 0, q.cast("double") / (10 ** digits))


def quarter_level(trips: str | Column) -> Column:
    t = _c(trips)
    return (F.when(t >= 4, K.LEVEL_HIGH)
             .when((t == 2) | (t == 3), K.LEVEL_MID)
             .otherwise(K.LEVEL_LOW))


def quarter_range_type(n_regions: str | Column, n_cities: str | Column) -> Column:
    """National / regional / single-city; null when nothing matched."""
    r, c = _c(n_regions), _c(n_cities)
    return (F.when(r >= 2, K.RANGE_NATIONAL)
             .when((r == 1) & (c >= 2), K.RANGE_REGIONAL)
             .when(c == 1, K.RANGE_SINGLE_CITY))


def lifetime_level(trips: str | Column, active_years: str | Column) -> Column:
    per_year = _c(trips) / _c(active_years)
    return (F.when(per_year >= 2, K.LEVEL_HIGH)
             .when(per_year >= 1, K.LEVEL_MID)
             .otherwise(K.LEVEL_LOW))


def lifetime_range_type(total_regions: str | Column, total_cities: str | Column) -> Column:
    return (F.when(_c(total_regions) >= 2, K.RANGE_NATIONAL)
             .when(_c(total_cities) >= 2, K.RANGE_REGIONAL)
             .otherwise(K.RANGE_SINGLE_CITY))
