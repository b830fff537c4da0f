"""Row cleaning: required columns, fills, safe casts, ranges, dates, dedupe, list explode."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop a row when any of ``cols`` is null."""
    return df.dropna(how="any", subset=list(cols))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column with a constant."""
    return df.fillna(dict(values))


def to_double(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text -> double; unparseable text becomes null instead of failing under ANSI mode."""
    for c in cols:
        df = df.withColumn(c, F.col(c).try_cast("double"))
    return df


def in_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]], upper_inclusive: bool = True) -> DataFrame:
    """Keep rows with ``lo <= col <= hi`` (or ``< hi``) for every column; nulls are dropped."""
    cond = None
    for c, (lo, hi) in bounds.items():
        col = F.col(c)
        part = (col >= lo) & ((col <= hi) if upper_inclusive else (col < hi))
        cond = part if cond is None else cond & part
    return df if cond is None else df.filter(cond)


def parse_date(df: DataFrame, src: str, out: str, pattern: str) -> DataFrame:
    """Parse text to a date; text that does not match the pattern becomes null."""
    return df.withColumn(out, F.try_to_date(F.col(src), pattern))


def add_year_month(df: DataFrame, date_col: str, year: str = "travel_year", month: str = "travel_month") -> DataFrame:
    return df.withColumn(year, F.year(date_col)).withColumn(month, F.month(date_col))


def rejected(df: DataFrame, parsed: str, show: Sequence[str]) -> DataFrame:
    """Rows whose parsed value is null: the data-quality reject report."""
    return df.filter(F.col(parsed).isNull()).select(*show)


def dedupe(df: DataFrame, keys: Sequence[str], smallest: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: per column, the smallest value among the copies.

    ``carry`` columns must be functions of the keys (they are grouped on, not
    chosen). This is a hash/sort aggregate with a map-side partial step, so a
    group of copies holding a large share of all rows is combined before the
    shuffle instead of landing in one task.
    """
    aggs = [F.min(c).alias(c) for c in smallest]
    out = df.groupBy(*keys, *carry).agg(*aggs)
    return out.select(*df.columns)


def dedupe_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest whole row (compared column by column)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    out = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def explode_list(df: DataFrame, src: str, out: str, sep: str) -> DataFrame:
    """Split a separated list into one row per element.

    Blank elements are dropped and kept elements are trimmed, so an id written
    as ``" 12"`` still joins to ``"12"``.
    """
    item = F.explode(F.split(F.col(src), sep, -1)).alias("_item")
    cols = [c for c in df.columns if c != src]
    return (df.select(*cols, item)
              .filter(F.trim(F.col("_item")) != "")
              .select(*cols, F.trim(F.col("_item")).alias(out)))
