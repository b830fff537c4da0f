"""Catalog tables stored in buckets, so that later jobs group by the bucket columns without a shuffle.

Rows are dealt by the hash that Spark gives buckets, so a task holds one bucket
and writes one file for each partition value. They aren't shuffled for that: each
task first writes a file for each bucket, and a second pass reads a bucket's files
as one partition, when the shuffles that made the rows are gone from the disks.
Parquet takes a fraction of a shuffle of wide rows. The files go to a new folder and a
table of their own; only when that table is whole does it take the old one's
name, so a write that raises changes nothing. Earlier folders stay for readers at
work until ``drop_old`` is called.

Buckets live in the catalog's entry: such tables need a catalog that outlives the
process (a Hive metastore on a cluster) and are read by name, not from a root path.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quartermart.session import shuffles_dropped
from quartermart.sources import schemas

VERSION, LOOSE = "buckets=", "loose="


def dealt(df: DataFrame, by: Sequence[str], number: int) -> DataFrame:
    """Rows dealt out as ``number`` buckets by ``by`` need them: one task a bucket."""
    return df.repartition(number, *by)


@contextmanager
def _buckets_read(spark: SparkSession) -> Iterator[None]:
    """Inside, a bucket's files are read as one partition, also by a plan that only writes them."""
    want = {"spark.sql.sources.bucketing.enabled": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k) for k in want}
    try:
        for k, v in want.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_bucketed(df: DataFrame, name: str, by: Sequence[str], number: int, schema: T.StructType | None = None,
                   partition_by: Sequence[str] = (), home: str | None = None, ready: bool = False) -> None:
    """Replace catalog table ``name`` by ``df`` in ``number`` buckets of ``by``.

    ``ready``: rows come from ``dealt`` with the same columns and number. ``home``
    is the folder of all versions; by default beside the database's tables.
    An empty ``df`` gives an empty table with the same buckets.
    """
    if schema is not None:
        schemas.check(df, schema)
        df = schemas.commented(df)
    spark = df.sparkSession
    db, _, table = name.rpartition(".")
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    home = home or f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}.buckets"
    version = uuid.uuid4().hex
    draft, loose = (f"{db}.{table}__{version}{x}" if db else f"{table}__{version}{x}" for x in ("", "_loose"))
    try:
        with shuffles_dropped(spark), _buckets_read(spark):
            if not ready:
                df.write.format("parquet").bucketBy(number, *by).option("path", f"{home}/{LOOSE}{version}").saveAsTable(loose)
            # dealt: Spark drops this shuffle, since the files are in these buckets
            rows = df if ready else dealt(spark.table(loose), by, number)
            writer = rows.write.format("parquet").bucketBy(number, *by).sortBy(*by).option("path", f"{home}/{VERSION}{version}")
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(draft)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {draft}")
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {loose}")
        _delete(spark, f"{home}/{LOOSE}{version}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry alone: the files are outside the catalog's own folders
    spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """(bucket columns, number of buckets) of a catalog table, None without buckets."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if not about.get("Num Buckets"):
        return None
    return [c.strip(" `") for c in about["Bucket Columns"].strip("[]").split(",")], int(about["Num Buckets"])


def drop_old(spark: SparkSession, name: str) -> int:
    """Delete the folders of earlier versions of ``name``; how many there were."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    jvm = spark.sparkContext._jvm
    now = jvm.org.apache.hadoop.fs.Path(about["Location"])
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(now.getParent())
           if s.getPath().getName().startswith(VERSION) and s.getPath().getName() != now.getName()]
    return sum(bool(fs.delete(p, True)) for p in old)
