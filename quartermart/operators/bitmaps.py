"""Exact distinct counts that merge: bitmaps over dense numbers.

Users and trips get numbers, dense within a range of their order (``number``).
Per group, the numbers present are bits of fixed words (64 numbers each), built
map-side, so a shuffle moves one row a group, task and word, however many visits
the group has, and never more than one a visit, however few numbers a group has
of each range. A word of a coarser group (city, year) is the union of those of
its parts, so it needs no visits any more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers whose presence one row of a state holds: the bits of a long.
WORD = 64


def number(df: DataFrame, key: str, out: str, order: Sequence[str] = ()) -> DataFrame:
    """Distinct ``key`` (not null) with the number ``out``, in the order of (``order``, key); write it before use.

    Rows are dealt by range of that order; a number is the range's own and the
    row's place in it, so numbers of neighbours share a word and keys that are
    counted together should be neighbours in ``order`` (functions of the key).
    The numbers hold only for one evaluation: a second one may cut other ranges.
    """
    cols = [*order, key]
    keys = df.where(F.col(key).isNotNull()).select(*cols).distinct()
    dealt = keys.repartitionByRange(*cols).sortWithinPartitions(*cols)
    return dealt.select(key, F.monotonically_increasing_id().alias(out))


def presence(df: DataFrame, group: Sequence[str], numbers: Mapping[str, str], sums: Mapping[str, Column]) -> DataFrame:
    """Per ``group``, kind and word: ``bits``; and the ``sums`` over its rows, on the kind ``rows``.

    ``numbers``: kind -> column with numbers. One pass: each row yields an entry a kind, combined map-side.
    """
    entries = [F.struct(F.lit("rows").alias("kind"), F.lit(None).cast("long").alias("no"))]
    entries += [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("no")) for kind, c in numbers.items()]
    e = df.select(*group, *[c.alias(name) for name, c in sums.items()], F.explode(F.array(*entries)).alias("e"))
    e = e.select(*group, *sums, F.col("e.kind").alias("kind"), F.col("e.no").alias("no")).where((F.col("kind") == "rows") | F.col("no").isNotNull())
    of_rows = F.col("kind") == "rows"
    bit = F.expr(f"shiftleft(1L, CAST(no % {WORD} AS INT))")
    return e.groupBy(*group, "kind", F.expr(f"no div {WORD}").alias("bucket")).agg(
        F.bit_or(bit).alias("bits"), *[F.sum(F.when(of_rows, F.col(name))).alias(name) for name in sums])


def merged(state: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The presence of coarser groups, from that of finer ones."""
    return state.groupBy(*group, "kind", "bucket").agg(F.bit_or("bits").alias("bits"), *[F.sum(c).alias(c) for c in sums])


def counts(state: DataFrame, group: Sequence[str], kinds: Mapping[str, str], sums: Sequence[str]) -> DataFrame:
    """One row a group: distinct numbers of each kind (kind -> column) and the sums."""
    return state.groupBy(*group).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))), F.lit(0)).alias(c) for kind, c in kinds.items()],
        *[F.sum(c).alias(c) for c in sums])
