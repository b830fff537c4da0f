"""Stages of the corpus pipeline, each a decision of one operator over whole documents.

Every stage takes and returns the columns of ``documents`` (the last one adds
its own). Whole texts go through Python workers, so the stages set
``spark.sql.execution.arrow.maxRecordsPerBatch`` to ``BATCH_ROWS`` at most for
their session: a batch then takes a few MB on either side.

Defined results: the language stage rejects null and empty texts and those
without letters; the others take them as their operators do. Rows that repeat id
and text are one document to line dedup (each row keeps what it keeps) and to
the Jaccard stage (one row stays); of ties the smallest id stays. Further columns
pass through, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, pack, read, split_by, unpack, write_table
from .decontaminate import with_leaks
from .jaccard import KEY_BITS, near_groups
from .language import UNKNOWN, learn, with_language
from .line_dedup import dedup_lines
from .mixing import mix

#: Documents whose profile is farther from every language are rejected; prose scores 0.35 and more.
MIN_LANGUAGE_SCORE = 0.2
#: Repeated passages of so many words and more go, in whatever lines they stand.
PASSAGE_WORDS = 50
#: Texts that travel together between Spark and a Python worker.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters or too far from every language's profile."""
    _small_batches(spark)
    found = with_language(pack(docs, "text"), learn(docs))
    known = found.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= MIN_LANGUAGE_SCORE))
    return unpack(known, docs.columns, ["text"])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated chunks of lines and repeated passages out of the texts; a document that loses all its words goes."""
    _small_batches(spark)
    needed = ["doc_id", "text", "n_chars"]
    lines = dedup_lines(pack(docs, *needed), PASSAGE_WORDS)
    same = (F.size("removed") == 0) & (F.size("passages") == 0)
    lines = lines.where(same | F.col("text").rlike(WORD))
    n = F.when(same, F.col("n_chars")).otherwise(F.length("text"))
    return unpack(lines.withColumn("n_chars", n), docs.columns, needed)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates; only texts of groups of several are shuffled."""
    _small_batches(spark)
    needed, key = ["doc_id", "text"], ["_id", "_print"]
    none = F.lit(-(1 << 63))
    groups = write_table(near_groups(docs, with_groups=True).where("n_shingles > 0").select("doc_id", "print", "group"), "jaccard-groups")
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("first"), F.count("*").alias("n"))
    name = lambda of="": [F.coalesce(F.col(f"{of}doc_id"), none).alias("_id"), F.col(f"{of}print").alias("_print")]
    several = groups.join(first.where("n > 1").select("group"), "group", "left_semi").select(*name())
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    named = pack(docs, *needed).withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), none), "_print": F.xxhash64("text")})
    some, alone = split_by(named, F.xxhash64(*key), several.select(F.xxhash64(*key).alias("key")), KEY_BITS, worded)
    kept = some.join(first.select(*name("first.")).hint("shuffle_hash"), key, "left_semi").dropDuplicates(key)
    return unpack(kept.unionByName(alone), docs.columns, needed)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, also with other numbers, names or units."""
    _small_batches(spark)
    clean = with_leaks(pack(docs, "text"), read(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0)
    return unpack(clean, docs.columns, ["text"])


def _cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The words [start, end) of a text with the white space between them; null for a null text."""
    word = re.compile(WORD)
    for text, start, end in batches:
        out = []
        for t, a, b in zip(text, start, end, strict=True):
            spans = [m.span() for m in word.finditer(t)][int(a):int(b)] if t is not None else []
            out.append(t[spans[0][0]:spans[-1][1]] if spans else None)
        yield pd.Series(out, dtype=object)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row for each copy or piece taken, numbered by ``copy``; ``n_words`` is its size."""
    _small_batches(spark)
    needed = ["doc_id", "source", "text", "n_chars"]
    mixed = mix(pack(docs, *needed))
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")), F.col("passes").cast("int"))
    rows = (mixed.where("taken > 0").select(*mixed.columns, F.posexplode(F.concat(whole, "pieces")).alias("copy", "piece"))
            .withColumns({"_a": F.col("piece.start"), "_b": F.col("piece.end")}))
    part = (F.col("_a") > 0) | (F.col("_b") < F.col("size"))
    cut = F.pandas_udf(_cut, "string")(F.when(part, F.col("text")), F.col("_a"), F.col("_b"))
    rows = rows.withColumn("text", F.coalesce(cut, F.col("text"))).withColumns({
        "n_chars": F.length("text").cast("long"), "n_words": F.col("_b") - F.col("_a")})
    return unpack(rows, docs.columns, needed, ["copy", "n_words", "source_size", "target"])
