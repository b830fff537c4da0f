"""Session helpers for tests, the benchmark and local runs.

On a cluster, use the cluster's session: nothing here overrides a setting the
cluster already has, except the few listed in ``build_session``'s arguments.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quartermart",
                  extra: dict | None = None) -> SparkSession:
    """A local session: UI off, AQE and skew handling on, UTC, small shuffle count."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("QM_DRIVER_MEMORY", "8g")))
    if master.startswith("local"):
        b = b.config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local master (tests) may go without: a scratch folder is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="qm-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written or collected inside (from a frame made inside) loses its shuffle files when it is done.

    Without, they stay on the executors' disks until the driver happens to collect garbage, so the steps of a job add up.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
