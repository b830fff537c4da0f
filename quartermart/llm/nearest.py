"""Operator 6: nearest neighbours by a block matrix join over int8 codes.

Vectors become int8 codes with a scale, the norm of the decoded vector and the
exact norm of what the code lost. Query and candidate blocks meet in tiles; a
tile multiplies the codes (in float32, where sums of int8 products are exact)
and bounds each inner product from both sides:
``|<x, y> - <x', y'>| <= |x'| |dy| + |dx| |y'| + |dx| |dy|``.
Pairs whose upper bound reaches the k-th lower bound survive, first within a
tile, then over all tiles of the query; survivors are recomputed from the
original vectors in double precision and merged by a heap for each query. The
bounds hold for every pair, so the result is exact.

Of equal vectors only the k + 1 with the smallest ids can be among the nearest
(the order breaks ties by id), so a vector that very many rows share stays
k + 1 candidates.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and null ids, take no part; rows repeating an id count
once (the smallest vector); vectors of another length than the query's are no
candidates; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import write_table

K = 20
QUERY_EVERY = 20
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
#: float32 sums of int8 products are exact over so many components.
EXACT_DIMS = 1024
_ROWS_AT_ONCE = 128


def usable(v: Column) -> Column:
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & ok & F.exists(v, lambda x: x != 0)


def _codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        code, scale, norm, lost = [], [], [], []
        for v in b["vec"]:
            x = np.asarray(v, np.float64)
            s = np.abs(x).max() / 127
            q = np.rint(x / s) if s > 0 else np.zeros_like(x)
            code.append(q.astype(np.int8).tobytes())
            scale.append(s)
            norm.append(float(np.linalg.norm(q * s)))
            lost.append(float(np.linalg.norm(x - q * s)))
        yield pd.DataFrame({"vec_id": b["vec_id"], "dims": b["vec"].map(len).astype("int32"), "code": code, "scale": scale, "norm": norm, "lost": lost})


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = 0.0
    for i in range(0, a.shape[1], EXACT_DIMS):
        out = out + (a[:, i:i + EXACT_DIMS] @ b[:, i:i + EXACT_DIMS].T).astype(np.float64)
    return out


def _tile(k: int):
    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(c):
            matrix = lambda f: np.frombuffer(b"".join(f["code"]), np.int8).reshape(len(f), -1).astype(np.float32)
            cm, (cid, cs, cn, cl) = matrix(c), (c[x].to_numpy() for x in ("vec_id", "scale", "norm", "lost"))
            for i in range(0, len(q), _ROWS_AT_ONCE):
                part = q.iloc[i:i + _ROWS_AT_ONCE]
                qid, qs, qn, ql = (part[x].to_numpy()[:, None] for x in ("vec_id", "scale", "norm", "lost"))
                about = _products(matrix(part), cm) * qs * cs
                slack = qn * cl + ql * cn + ql * cl
                slack += 1e-12 * (qn + ql) * (cn + cl)
                low = np.where(qid == cid, -np.inf, about - slack)
                floor = np.partition(low, -k, axis=1)[:, -k][:, None] if low.shape[1] > k else -np.inf
                keep = (about + slack >= floor) & (qid != cid)
                r, j = np.nonzero(keep)
                out.append(pd.DataFrame({"query_id": qid[r, 0], "vec_id": cid[j], "low": low[r, j], "high": (about + slack)[r, j]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "low": [], "high": []})

    return tile


def _heap(k: int):
    def merge(pairs: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip(-pairs["score"], pairs["vec_id"], strict=True))
        return pd.DataFrame({"query_id": pairs["query_id"].iloc[0], "rank": range(1, len(best) + 1),
                             "vec_id": [v for _, v in best], "score": [-s for s, _ in best]})

    return merge


def nearest(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY, query_block: int = QUERY_BLOCK,
            candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products for every query, ties to the smaller id."""
    vectors = write_table(
        embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .groupBy("vec_id").agg(F.min("embedding").alias("vec")), "vectors")
    coded = vectors.mapInPandas(_codes, "vec_id long, dims int, code binary, scale double, norm double, lost double")
    coded = write_table(coded.join(vectors, "vec_id"), "codes")
    same = W.partitionBy("vec").orderBy("vec_id")
    candidates = write_table(coded.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n", "vec"), "candidates")
    queries = coded.where(F.col("vec_id") % query_every == 0).drop("vec")
    q_blocks = max(1, -(-queries.count() // query_block))
    c_blocks = max(1, -(-candidates.count() // candidate_block))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.withColumn("qb", deal(q_blocks)).withColumn("cb", every(c_blocks))
    c = candidates.withColumn("cb", deal(c_blocks)).withColumn("qb", every(q_blocks))
    tile = ["dims", "qb", "cb"]
    pairs = q.groupBy(*tile).cogroup(c.groupBy(*tile)).applyInPandas(_tile(k), "query_id long, vec_id long, low double, high double")
    pairs = write_table(pairs, "pairs")
    floor = (pairs.withColumn("_n", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("low").desc())))
             .where(F.col("_n") <= k).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("low")).otherwise(float("-inf")).alias("floor")))
    pairs = pairs.join(floor, "query_id").where("high >= floor").select("query_id", "vec_id")
    side = lambda name, vec: vectors.select(F.col("vec_id").alias(name), F.col("vec").alias(vec))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.join(side("vec_id", "b"), "vec_id").join(side("query_id", "a"), "query_id").select("query_id", "vec_id", product.alias("score"))
    return scored.groupBy("query_id").applyInPandas(_heap(k), "query_id long, rank int, vec_id long, score double")
