"""The corpus pipeline: documents in, a deduplicated, clean mix of sources out.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. SQL can't express the language, Jaccard and template stages, so
``ORACLE_SQL`` is None and tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quartermart.llm import stages
from quartermart.llm.common import read, write_table

STAGES = [
    ("language", stages.keep_known_language),
    ("line_dedup", stages.drop_repeated_lines),
    ("jaccard_join", stages.keep_one_of_group),
    ("decontaminate", stages.drop_leaks),
    ("mix_sources", stages.mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is written to the shared checkpoint folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
