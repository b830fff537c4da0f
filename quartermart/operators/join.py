"""Fact-to-dimension equi-joins: the planner's choice, or a forced form.

Forcing a broadcast takes a proof: one aggregate over the dimension (rows and
string bytes of the projected columns) must be within the limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row overhead used when measuring (UnsafeRow header, null bitmap, offsets).
_ROW_OVERHEAD = 16
_FIXED_WIDTH = 8


@dataclass(frozen=True)
class DimSize:
    rows: int
    bytes: int


def measure(dim: DataFrame) -> DimSize:
    """Exact row count and an upper bound of the in-memory bytes of ``dim``."""
    parts = [F.count(F.lit(1)).alias("rows")]
    width = F.lit(0)
    fixed = 0
    for f in dim.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            # bytes, not characters: UTF-8 text outside ASCII takes up to 4 bytes a character
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)) + 16
        else:
            fixed += _FIXED_WIDTH
    parts.append(F.sum(width).alias("var_bytes"))
    row = dim.agg(*parts).first()
    rows = int(row["rows"] or 0)
    var = int(row["var_bytes"] or 0)
    return DimSize(rows=rows, bytes=var + rows * (fixed + _ROW_OVERHEAD))


def broadcast_limit(spark) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                      ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return 10 << 20


#: Heavy keys looked for, and the share of the rows, as a part of a shuffle partition, above which a key is heavy.
HEAVY_KEYS, HEAVY_SHARE = 1000, 0.25
SPLIT = "split"
#: A form of join that broadcasts a dimension of so many measured bytes at most.
BOUNDED, BOUNDED_BYTES = "bounded", 64 << 20


def heavy_keys(fact: DataFrame, key: str, share: float | None = None, most: int = HEAVY_KEYS) -> list:
    """Values of ``key`` that may hold more than ``share`` of the rows: at most ``most``, from a summary that merges.

    The summary (Spark's frequent-items sketch) holds 8 times as many counters as asked for, whatever the number of
    keys, and is built map-side. By its error bound it misses no key above 1 / (3 * most) of the rows. A key that is
    taken for heavy by mistake costs one more broadcast row.
    """
    if share is None:
        share = HEAVY_SHARE / int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = fact.agg(F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(8 * most)).alias("top"), F.count(key).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] > share * found["n"]]


def split_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left", share: float | None = None, heavy: Sequence | None = None) -> DataFrame:
    """``fact JOIN dim USING (key)`` whose heavy keys never meet in one task, with or without AQE.

    Rows of heavy keys (``heavy``, or those found) and of null keys stay where they are and meet a broadcast of the
    dimension's rows of those keys, at most ``HEAVY_KEYS`` keys; all others are shuffled into a merge join. ``dim`` is
    unique by key, else its rows of heavy keys are as many as they are.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a split join is left or inner, not {how}")
    keys = [k for k in (heavy_keys(fact, key, share) if heavy is None else heavy) if k is not None]
    hot = F.col(key).isNull() | F.col(key).isin(keys) if keys else F.col(key).isNull()
    few = dim.where(F.col(key).isin(keys)) if keys else dim.where(F.lit(False))
    near = fact.where(hot).join(F.broadcast(few), on=key, how=how)
    far = fact.where(~hot).join(dim.hint("merge"), on=key, how=how)
    return near.unionByName(far)


def attach_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
               broadcast: bool | str | None = None, limit: int | None = None) -> DataFrame:
    """``fact JOIN dim USING (on)``.

    ``broadcast=None`` leaves the join to the planner, which broadcasts by the
    known size and otherwise shuffles, with AQE splitting hot keys. ``True``
    broadcasts a dimension whose measured size is within ``limit`` (default:
    ``spark.sql.autoBroadcastJoinThreshold``) and raises beyond it. ``False``
    plans a shuffled sort-merge join. ``SPLIT`` is ``split_join``, for one key.
    ``BOUNDED`` broadcasts within ``limit`` (default: ``BOUNDED_BYTES``), so the
    fact's rows stay where they are, and leaves larger dimensions to the planner.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast == SPLIT:
        (key,) = keys
        return split_join(fact, dim, key, how)
    if broadcast == BOUNDED:
        if measure(dim).bytes <= (BOUNDED_BYTES if limit is None else limit):
            dim = F.broadcast(dim)
    elif broadcast:
        cap = broadcast_limit(dim.sparkSession) if limit is None else limit
        size = measure(dim).bytes
        if size > cap:
            raise ValueError(f"the dimension takes {size} bytes, more than may be broadcast ({cap})")
        dim = F.broadcast(dim)
    elif broadcast is False:
        dim = dim.hint("merge")
    return fact.join(dim, on=keys, how=how)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache a frame reused by several actions for the duration of a block.

    Blocks lost with an executor are recomputed from lineage, so this is safe
    under executor loss; it is released when the block ends.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
