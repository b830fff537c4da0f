"""Operator 1: mixing sources to target weights (Sainte-Lague block quotas).

Every source gets a target of words: its weight's share of all words, stopped
at ``max_repeat`` times what it has, the excess going to the others by weight.
The words are dealt out in blocks of ``block_tokens``: sources get integer
block quotas by highest quotients (votes / 1, 3, 5, ...), and each source's
quota is dealt the same way to its shards. A shard is a bounded, seeded random
part of a source with its documents in seeded order, cut into equal blocks. It
gives its quota as whole passes over the shard, then one run of consecutive
blocks (circular) from a seeded start. Hence documents stay whole except at
the two ends of a run.

Defined results: a null text has size 0 and nothing is taken; null sources
form one source, last in order; repeated rows are rows of their own; an empty
table gives an empty result; other columns pass through under their names,
those named like a column the operator adds are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, pack, unpack, write_table

WEIGHTS = (1, 2, 3)
BLOCK_TOKENS = 32
SHARD_TOKENS = 1_000_000
MAX_REPEAT = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(parties: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """Seats of each party by highest quotients ``_votes / (2 j - 1)``, ties by ``key``.

    ``parties`` has ``group`` columns, ``key``, ``_votes``, ``_cap`` (most seats
    of the party) and ``_seats`` (to deal out in the group). Rounding shifts
    the fair share of a party by at most the number of parties over all, so
    only seats in that margin compete: a few rows for each party.
    """
    every = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    n, total = F.count("*").over(every), F.sum("_votes").over(every)
    share = F.when(F.col("_total") > 0, F.col("_votes") / F.col("_total")).otherwise(0.0)
    p = parties.withColumns({"_n": n, "_total": total}).withColumns({
        "_low": F.greatest(F.lit(0), F.least(F.col("_cap"), F.floor(share * (F.col("_seats") - F.col("_n"))) - 1)),
        "_high": F.greatest(F.lit(0), F.least(F.col("_cap"), F.ceil(share * (F.col("_seats") + F.col("_n"))) + 2))})
    p = p.withColumn("_open", F.col("_seats") - F.sum("_low").over(every))
    tried = p.where("_high > _low").select(
        *group, key, "_votes", "_open", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
    order = every.orderBy((F.col("_votes") / (2 * F.col("_j") - 1)).desc(), F.col(key))
    won = (tried.withColumn("_place", F.row_number().over(order)).where("_place <= _open")
           .groupBy(*group, key).agg(F.count("*").alias("_won")))
    return (p.join(won, [*group, key], "left")
            .withColumn("_quota", F.col("_low") + F.coalesce("_won", F.lit(0)))
            .drop("_n", "_total", "_low", "_high", "_open", "_won"))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(_src, source_size, _rows, target): one row for each source.

    The level L with sum(least(weight * L, max_repeat * size)) = all words is
    found at the first source, by cap / weight, that stays below its cap.
    """
    one = W.partitionBy(F.lit(0))
    s = sized.groupBy("_src").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    place = (F.row_number().over(one.orderBy("_src")) - 1) % len(weights)
    s = s.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + 1).cast("long"))
    s = s.withColumns({"_cap": max_repeat * F.col("source_size"),
                       "_ratio": (max_repeat * F.col("source_size")).cast("double") / F.col("_w")})
    before = one.orderBy("_ratio", "_src").rowsBetween(W.unboundedPreceding, -1)
    after = one.orderBy("_ratio", "_src").rowsBetween(W.currentRow, W.unboundedFollowing)
    level = ((F.sum("source_size").over(one) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double")
             / F.sum("_w").over(after))
    s = s.withColumn("_level", level)
    s = s.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"),
                                            F.struct("_ratio", "_src", "_level"))).over(one)["_level"])
    return s.select("_src", "source_size", "_rows",
                    F.least(F.col("_w") * F.col("_level"), F.col("_cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, block_tokens: int = BLOCK_TOKENS,
        shard_tokens: int = SHARD_TOKENS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
        keep_text: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with what the mix takes of each row.

    Adds ``size`` (words), ``source_size``, ``target``, ``passes`` (whole copies),
    ``pieces`` (word ranges [start, end) taken once more) and ``taken`` (words,
    repeats counted). Without ``keep_text`` only doc_id and source are kept of ``docs``.
    """
    src = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col("source")))
    needed = ["doc_id", "source", "text"] if keep_text else ["doc_id", "source"]
    sized = pack(docs, "doc_id", "source", "text").withColumns({"size": n_words(F.col("text")), "_src": src})
    sized = write_table(sized.withColumn("_print", F.xxhash64("text")) if keep_text else sized.drop("text", "_row"), "mix-sized")
    mixed = deal(sized, weights, block_tokens, shard_tokens, max_repeat, seed)
    return unpack(mixed, docs.columns if keep_text else needed, needed, ["size", "source_size", "target", "passes", "pieces", "taken"])


def deal(sized: DataFrame, weights: Sequence[int], block_tokens: int, shard_tokens: int, max_repeat: int,
         seed: str) -> DataFrame:
    """``mix`` for rows that have ``size`` and ``_src`` already."""
    b = block_tokens
    blocks = lambda words: F.floor((words + F.lit(b / 2)) / b)
    sources = source_targets(sized, weights, max_repeat)
    sources = sources.withColumns({
        "_votes": F.col("target"), "_cap": F.ceil(max_repeat * F.col("source_size") / b),
        "_seats": blocks(F.sum("source_size").over(W.partitionBy(F.lit(0))))})
    sources = write_table(sainte_lague(sources, [], "_src").select(
        "_src", "source_size", "target", "_quota",
        F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("_rows")) / shard_tokens)).alias("_shards")),
        "mix-sources")

    draw = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size"))
    placed = sized.join(sources, "_src").withColumn("_draw", draw)
    placed = placed.withColumn("_shard", F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long") % F.col("_shards"))
    shards = placed.groupBy("_src", "_shard").agg(
        F.sum("size").alias("_words"), F.first("_quota").alias("_seats"))
    shards = sainte_lague(shards.withColumns({
        "_votes": F.col("_words").cast("double"), "_cap": F.ceil(max_repeat * F.col("_words") / b)}),
        ["_src"], "_shard")
    give = F.least(F.col("_quota") * b, max_repeat * F.col("_words"))
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "_src", "_shard")), 1, 8), 16, 10).cast("long")
    some = F.col("_words") > 0
    shards = shards.select("_src", "_shard", "_words", F.when(some, give).otherwise(0).alias("_give"),
                           F.when(some, start % F.ceil(F.col("_words") / b) * b).otherwise(0).alias("_start"))
    shards = shards.withColumns({
        "_passes": F.when(F.col("_words") > 0, F.floor(F.col("_give") / F.col("_words"))).otherwise(0),
        "_end": F.when(F.col("_words") > 0, F.col("_give") % F.col("_words")).otherwise(0) + F.col("_start")})

    ties = ["_print"] if "_print" in placed.columns else []  # rows of one id and size differ by their text only
    order = W.partitionBy("_src", "_shard").orderBy("_draw", "doc_id", "size", *ties)
    rows = placed.join(shards, ["_src", "_shard"]).withColumn(
        "_to", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    rows = rows.withColumn("_from", F.col("_to") - F.col("size"))
    piece = lambda lo, hi: F.struct(
        (F.greatest(F.col("_from"), lo) - F.col("_from")).alias("start"),
        (F.least(F.col("_to"), hi) - F.col("_from")).alias("end"))
    pieces = F.filter(F.array(piece(F.col("_start"), F.least("_end", "_words")),
                              piece(F.lit(0), F.col("_end") - F.col("_words"))),
                      lambda p: p["end"] > p["start"])
    rows = rows.withColumns({"passes": F.col("_passes").cast("long"), "pieces": pieces})
    extra = F.aggregate("pieces", F.lit(0).cast("long"), lambda acc, p: acc + p["end"] - p["start"])
    rows = rows.withColumn("taken", F.col("passes") * F.col("size") + extra)
    return rows.drop(*[c for c in rows.columns if c.startswith("_") and c != "_row"])
