"""Most frequent values without shuffling all values: bounded summaries, then exact counts of the candidates.

Spark's frequent-items aggregate keeps at most ``tracked`` values a task and merged;
every value with more than total / tracked rows is among them. The candidates are
then counted exactly. If the n-th largest exact count is above that bound, no other
value can be among the first n, so the report is proven; else the values are too
even for it, and all are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermart.operators.join import broadcast_limit, measure
from quartermart.operators.profile import frequency

MOST_TRACKED = 10_000  # the aggregate's own limit


def candidates(df: DataFrame, col: str, tracked: int = MOST_TRACKED) -> list:
    """Values of ``col``, nulls aside, that may have more than a ``tracked``-th of the rows: at most ``tracked``."""
    if not 1 <= tracked <= MOST_TRACKED:
        raise ValueError(f"1 to {MOST_TRACKED} values can be tracked, not {tracked}")
    row = df.select(F.col(f"`{col}`").alias("v")).where(F.col("v").isNotNull()).stat.freqItems(["v"], 1 / tracked).first()
    return [v for v in (row[0] or []) if v is not None]


def top_frequency(df: DataFrame, col: str, n: int, tracked: int = MOST_TRACKED, count_col: str = "count") -> tuple[DataFrame, bool]:
    """(``frequency(df, [col], n)``, whether the summaries proved it).

    Most frequent first, ties by value with null first. An empty table gives no rows.
    Reads ``df`` twice, or three times where all values have to be counted.
    """
    spark = df.sparkSession
    values = spark.createDataFrame([(v,) for v in candidates(df, col, tracked)], df.select(F.col(f"`{col}`").alias("_v")).schema)
    if measure(values).bytes > broadcast_limit(spark):
        return frequency(df, [col], n, count_col=count_col), False
    marked = df.select(F.col(f"`{col}`").alias(col)).join(F.broadcast(values.withColumn("_known", F.lit(True))), F.col(f"`{col}`").eqNullSafe(F.col("_v")), "left")
    # One more group holds all rows that are no candidate's; null is always a candidate.
    known = F.col("_known").isNotNull() | F.col(f"`{col}`").isNull()
    counts = marked.groupBy(F.when(known, F.col(f"`{col}`")).alias(col), known.alias("_known")).agg(F.count(F.lit(1)).alias(count_col)).collect()
    total = sum(r[count_col] for r in counts)
    kept = sorted((r[count_col] for r in counts if r["_known"]), reverse=True)
    others = total - sum(kept)
    least = kept[n - 1] if len(kept) >= n else 0
    if others and least * tracked <= total:
        return frequency(df, [col], n, count_col=count_col), False
    rows = [(r[col], r[count_col]) for r in counts if r["_known"]]
    schema = marked.select(col).schema.add(count_col, "long")
    out = spark.createDataFrame(rows, schema)
    return out.orderBy(F.col(count_col).desc(), F.col(f"`{col}`").asc_nulls_first()).limit(n), True
