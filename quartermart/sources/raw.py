"""Raw CSV scans: UTF-8, every column text (no schema inference), columns found by header name, bad rows kept apart.

A folder's files may differ in the order of their columns: files are grouped by
their header and each group is read by its own. Spark checks the header of every
file against that schema (``enforceSchema=false``), so a column can't be taken
for another. Rows that don't fit go to the rejects, with file, reason and text:

* ``short``: fewer fields than the header;
* ``long``: more fields than the header;
* ``quote``: a quotation mark without its pair.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermart.functions import constants as K
from quartermart.sources import schemas

CORRUPT = "_corrupt_record"
#: Different headers that one load may have; more means that files have no header at all.
MAX_HEADERS = 100
REJECT_COLUMNS = ["file", "reason", "line"]


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The distinct header lines below ``path`` with the files that have them (a row for each file reaches the driver)."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where("file_block_start = 0").withColumn("place", F.monotonically_increasing_id())
    firsts = lines.groupBy("file_path").agg(F.min_by("value", "place").alias("header"))
    kinds = firsts.groupBy("header").count().limit(MAX_HEADERS + 1).count()
    if kinds > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers; do the files have one?")
    found: dict[str, list[str]] = {}
    for r in firsts.toLocalIterator():
        found.setdefault(r["header"].removeprefix("\ufeff").rstrip("\r"), []).append(r["file_path"])
    return found


def _unquoted(line: Column) -> Column:
    """``line`` without its closed quoted parts."""
    return F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")


def _reason(line: Column, fields: int) -> Column:
    """Why a line has not as many fields as its header."""
    bare = _unquoted(line)
    n = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.when(bare.contains('"'), "quote").when(n < fields, "short").otherwise("long")


def scan_raw_csv(spark: SparkSession, path: str, schema: T.StructType,
                 renames: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of the headered CSV files below ``path``.

    Good rows have the columns of ``schema`` in its order (renamed), whatever
    the order in a file; a header that lacks one raises. Rejects have
    :data:`REJECT_COLUMNS`. Empty lines are no rows.
    """
    parts = []
    for header, files in headers(spark, path).items():
        names = next(csv.reader([header]))
        missing = [c for c in schema.names if c not in names]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}; its header is {', '.join(names)}")
        if len(set(names)) < len(names):
            raise ValueError(f"{files[0]} has a column twice; its header is {', '.join(names)}")
        read = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
        rows = (spark.read.schema(read)
                .option("header", True)
                .option("enforceSchema", False)
                .option("encoding", "UTF-8")
                .option("mode", "PERMISSIVE")
                .option("columnPruning", False)     # every field is parsed, so that every bad row shows
                .option("columnNameOfCorruptRecord", CORRUPT)
                .csv(files))
        # a count of rejects alone would ask for no column but the corrupt one, which Spark refuses; no text is shorter than empty
        line = F.coalesce(CORRUPT, F.when(F.length(F.col(f"`{names[0]}`")) < 0, ""))
        parts.append(rows.select(*[F.col(f"`{c}`") for c in schema.names], line.alias("line"),
                                 _reason(F.col(CORRUPT), len(names)).alias("reason"), F.col("_metadata.file_path").alias("file")))
    if not parts:
        raise ValueError(f"{path} has no files with a header")
    every = reduce(DataFrame.unionByName, parts)
    good = every.where("line IS NULL").select(*[F.col(f"`{c}`") for c in schema.names])
    return (rename(good, renames) if renames else good), every.where("line IS NOT NULL").select(*REJECT_COLUMNS)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType,
                 renames: Mapping[str, str] | None = None) -> DataFrame:
    """The good rows of ``scan_raw_csv``."""
    return scan_raw_csv(spark, path, schema, renames)[0]


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Project and rename in one ``select`` (source header -> snake_case)."""
    return df.select(*[F.col(src).alias(dst) for src, dst in renames.items()])


def scan_poi_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return scan_raw_csv(spark, path, schemas.RAW_POI_CSV, K.POI_HEADER_RENAMES)


def scan_trip_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return scan_raw_csv(spark, path, schemas.RAW_TRIP_CSV, K.TRIP_HEADER_RENAMES)


def read_poi_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_poi_csv(spark, path)[0]


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_trip_csv(spark, path)[0]
