"""Ranks, arg-max, ties-of-the-best and top-N.

Every ordering ends in a unique tie-break, so ``row_number`` is repeatable.

Full ranking of a scope (``rank_in``) has two physical forms, named by the caller:

* ``WINDOW`` (default): ``row_number() OVER (PARTITION BY scope ORDER BY ...)``.
  One task sorts each scope, spilling as needed. It suits scopes bounded by a
  dimension, such as the POIs of a quarter.
* ``RANGE``: exact and distributed for unbounded scopes. Rows are range
  partitioned on (scope, order) and checkpointed to the cluster's checkpoint
  directory, which fixes each row's partition; a row's rank is its position
  inside its range partition plus the number of rows of its scope in earlier
  partitions. Every window then holds at most one range partition, or at most
  one row per partition and scope.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermart.session import ensure_checkpoint_dir


def _order(by: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(by).desc()] + [F.col(t).asc() for t in tiebreak]


WINDOW, RANGE = "window", "range"


def rank_in(df: DataFrame, scopes: Mapping[str, Sequence[str]], by: str,
            tiebreak: Sequence[str], form: str = WINDOW) -> DataFrame:
    """Add one rank column per scope: ``{out_col: partition_cols}``.

    Order is ``by`` descending then ``tiebreak`` ascending (unique), ranks are
    1..n per scope, in either form.
    """
    if form not in (WINDOW, RANGE):
        raise ValueError(f"unknown form of ranking: {form}")
    if form == WINDOW:
        order = _order(by, tiebreak)
        # Coarsest scope first: finer scopes that contain its keys reuse its clustering.
        for out in sorted(scopes, key=lambda k: len(scopes[k])):
            df = df.withColumn(out, F.row_number().over(Window.partitionBy(*scopes[out]).orderBy(*order)))
        return df
    ensure_checkpoint_dir(df.sparkSession)
    for out, scope in scopes.items():
        df = range_rank(df, scope, by, tiebreak, out)
    return df


def range_rank(df: DataFrame, scope: Sequence[str], by: str, tiebreak: Sequence[str], out: str,
               partitions: int | None = None) -> DataFrame:
    """Exact ``row_number`` per scope without sorting a whole scope in one task."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _order(by, tiebreak)
    keyed = (df.repartitionByRange(n, *[F.col(c).asc() for c in scope], *order)
               .withColumn("_part", F.spark_partition_id()))
    # Range bounds come from a sample; the checkpoint pins each row's partition
    # so the two reads below (positions and counts) agree, also after a lost executor.
    keyed = keyed.checkpoint(eager=True)
    local = keyed.withColumn("_local", F.row_number().over(
        Window.partitionBy("_part", *scope).orderBy(*order)))
    counts = keyed.groupBy(*scope, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_o_{c}") for c in scope], F.col("_part").alias("_o_part"),
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    cond = F.col("_part") == F.col("_o_part")
    for c in scope:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    ranked = local.join(offsets, cond, "inner")
    return (ranked.withColumn(out, (F.col("_off") + F.col("_local")).cast("int"))
                  .drop("_part", "_local", "_off", "_o_part", *[f"_o_{c}" for c in scope]))


def top_n(df: DataFrame, keys: Sequence[str], by: str, n: int, tiebreak: Sequence[str],
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` per ``keys``; Catalyst plans a partial group limit
    before the shuffle, so each group ships at most ``n`` rows per task."""
    w = Window.partitionBy(*keys).orderBy(*_order(by, tiebreak))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
