"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermart.session import ensure_checkpoint_dir, shuffles_dropped

#: A word: a run of characters other than space and the ASCII controls tab .. carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows whose crc32(id as text) has this remainder are held out of every training.
FOLDS, HELD_OUT_FOLD = 4, 2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Whether the row is held out; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT_FOLD


def send(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast an object of one of this package's classes with its class, so executors need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent: Broadcast) -> object:
    """What ``send`` sent, built once for each Python worker."""
    if not hasattr(sent, "_model"):
        sent._model = cloudpickle.loads(sent.value)
    return sent._model


def pack(df: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns and ``_row``, a struct of all others, so that no other name can clash."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in needed]
    return df.select(*needed, (F.struct(*others) if others else F.lit(None)).alias("_row"))


def unpack(df: DataFrame, columns: Sequence[str], needed: Sequence[str], own: Sequence[str] = ()) -> DataFrame:
    """``columns`` as they were before ``pack``, then the operator's ``own``, which replace columns of those names."""
    names = {c.lower() for c in own}
    return df.select(*(F.col(c) if c in needed else F.col("_row").getField(c).alias(c) for c in columns if c.lower() not in names), *own)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can read again, so a lost
    executor costs at most the tasks it was running. What was shuffled for it
    goes from the executors' disks when it is written.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table of ``write_table`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    home = sc.getCheckpointDir()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == sc._jvm.org.apache.hadoop.fs.Path(home).toUri().getPath():  # ours
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def bitmap_of(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` classes (16 bits and more) with a bit set for the class (top bits) of every 64-bit ``key``; its size is fixed."""
    block = F.shiftrightunsigned(F.col(key), 64 - bits + 15)
    place = F.shiftrightunsigned(F.col(key), 64 - bits).bitwiseAND(F.lit((1 << 15) - 1))
    out = np.zeros((1 << bits - 15, 4096), np.uint8)
    with shuffles_dropped(keys.sparkSession):
        for r in keys.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits")).collect():
            out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Whether the classes of the 64-bit ``keys`` have their bit set."""
    c = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (bitmap[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def split_by(docs: DataFrame, key: Column, keys: DataFrame, bits: int, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` (that fulfil ``where``) whose 64-bit ``key`` may be among ``keys`` (column ``key``), and all others: told by a bitmap, without a shuffle."""
    some = docs.sparkSession.sparkContext.broadcast((bitmap_of(keys, "key", bits), bits))

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bitmap, bits = some.value
        for k in batches:
            yield pd.Series(in_bitmap(bitmap, bits, k.to_numpy()))

    told = docs.withColumn("_told", known.asNondeterministic()(key) & (F.lit(True) if where is None else where))
    return told.where("_told").drop("_told"), told.where("not _told").drop("_told")
