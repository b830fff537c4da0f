"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import read
from .decontaminate import leaked_items
from .fill_middle import restored, to_fill_middle
from .jaccard import near_groups
from .language import label_languages
from .line_dedup import dedup_lines
from .mixing import mix
from .nearest import nearest
from .phrases import collocations
from .token_file import round_trip as token_round_trip
from .toxicity import judge_toxicity
from .url_filter import judge
from .warc import round_trip
from .wordpiece import count_tokens


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, keep_text=False).select("doc_id", "source", "size", "source_size", "target", "passes", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0), lambda n, r: n + r["end"] - r["start"])
    return lines.select("doc_id", "n_lines", gone.alias("n_removed"), "text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, max_word_bytes=None).select("doc_id", "n_words", "n_tokens")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_languages(read(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "runner_up")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (judge_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
            .select("doc_id", "held_out", "score", "predicted", "n_windows"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(read(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = to_fill_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(read(spark, sf_dir, "documents").select("text", "lang"))
    return found.withColumnRenamed("grp", "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix_sources, op2_line_dedup, op3_token_counts, op4_language, op5_decontaminate,
                                     op6_nearest, op7_warc, op8_toxicity, op9_jaccard_join, op10_url_filter, op11_token_file, op12_fill_middle, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": sql.OP1, "op2_line_dedup": sql.OP2, "op6_nearest": sql.OP6, "op7_warc": sql.OP7, "op10_url_filter": sql.OP10,
            "op12_fill_middle": sql.OP12, "op13_phrases": sql.OP13}
