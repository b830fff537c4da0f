"""Data-quality reports returned as DataFrames (never printed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``min_<col>`` and ``max_<col>`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def frequency(df: DataFrame, cols: Sequence[str], n: int | None = None,
              by_count: bool = True, count_col: str = "count") -> DataFrame:
    """Rows per value of ``cols``.

    ``by_count``: most frequent first, ties by value; else ordered by value.
    ``n`` keeps the first ``n`` rows of that total order (a top-k report;
    Spark plans it as a bounded take-ordered, not a full sort).
    """
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
    order = ([F.col(count_col).desc()] if by_count else []) + [F.col(c).asc_nulls_first() for c in cols]
    out = out.orderBy(*order)
    return out.limit(n) if n is not None else out
