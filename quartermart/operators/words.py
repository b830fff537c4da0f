"""First-match rules of plain words over large rule lists: a hash join in place of one CASE.

A CASE tries every rule on every row. Here each distinct text is taken apart into
its substrings of the words' lengths, which meet the words by an equi-join; the
smallest rule number wins. The time depends on the texts' lengths and the number
of different word lengths, not on the number of rules.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermart.functions.rules import CategoryRules, sql_string
from quartermart.operators.join import attach_dim, broadcast_limit, measure

_PLAIN = re.compile(r"[^\\.\[\]{}()*+?^$|]+")


def plain_words(pattern: str) -> list[str] | None:
    """Words of a pattern ``w1|w2|...``; None if it says more than that."""
    words = pattern.split("|")
    return words if all(_PLAIN.fullmatch(w) for w in words) else None


def _substrings(text: Column, lengths: list[int]) -> Column:
    """Distinct substrings of ``text`` of the given lengths."""
    def of(size: int) -> Column:
        places = F.sequence(F.lit(1), F.char_length(text) - (size - 1))
        return F.when(F.char_length(text) >= size, F.transform(places, lambda i: F.substring(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of(n) for n in lengths]))


def categories_by_words(df: DataFrame, rules: CategoryRules, text: str = "label_zh", out: str = "category",
                        broadcast: bool | str | None = None) -> DataFrame:
    """``df`` with the category of ``rules`` as ``out``: equal to ``rules.column(text)``.

    Patterns that are more than words joined by ``|`` are tried by a CASE and
    compete by their rule number. A null text gets the default, as a CASE gives.
    ``broadcast`` is how the found categories of distinct texts meet ``df`` again
    (see ``attach_dim``; ``"split"`` for texts that many rows share).
    """
    first: dict[str, tuple[int, str]] = {}
    regexes = []
    for number, (label, pattern) in enumerate(rules.patterns):
        words = plain_words(pattern)
        if words is None:
            regexes.append((number, label, pattern))
        for w in words or ():
            first.setdefault(w, (number, label))
    spark, col = df.sparkSession, f"`{text}`"
    tail = (f"CASE WHEN {col} = {sql_string(rules.no_label)} THEN {sql_string(rules.unclassified)} "
            f"ELSE {sql_string(rules.default)} END")
    found = []
    if first:
        words = spark.createDataFrame([(w, n, label) for w, (n, label) in first.items()], "_word string, _number int, _label string")
        texts = df.select(F.col(col).alias("_text")).where(F.col("_text").isNotNull()).distinct()
        pieces = texts.select("_text", F.explode(_substrings(F.col("_text"), sorted({len(w) for w in first}))).alias("_word"))
        small = measure(words).bytes <= broadcast_limit(spark)
        hits = (attach_dim(pieces, words, "_word", how="inner", broadcast=True if small else None)
                .groupBy("_text").agg(F.min(F.struct("_number", "_label")).alias("_hit")).withColumnRenamed("_text", text))
        df = attach_dim(df, hits, text, how="left", broadcast=broadcast)
        found.append(F.col("_hit"))
    if regexes:
        case = " ".join(f"WHEN {col} RLIKE {sql_string(p)} THEN named_struct('_number', {n}, '_label', {sql_string(label)})" for n, label, p in regexes)
        found.append(F.expr(f"CASE {case} END").cast("struct<_number:int,_label:string>"))
    best = (F.least(*found) if len(found) > 1 else found[0]).getField("_label") if found else F.lit(None).cast("string")
    return df.withColumn(out, F.coalesce(best, F.expr(tail))).drop("_hit")
