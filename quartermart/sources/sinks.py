"""Layer tables: all-or-nothing overwrite, whole or by partition, in the catalog or under a root path.

With ``root`` a table ``layer.name`` lives in the folder ``root/layer/name`` and
needs no metastore, so any process that knows the root can read it. Without,
tables are those of the session catalog, one database per layer; their files are
in ``<name>.versions`` of the database's folder and the catalog's entry is made
anew after every commit. Either way a write that raises leaves the old rows
readable (see ``versions``), and ``read_table`` follows the last commit.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quartermart.sources import schemas, versions

LAYERS = ("ods", "dwd", "dws", "ads")


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    for db in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def location(name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def _home(spark: SparkSession, name: str, root: str | None) -> str:
    """Folder of the table's versions."""
    if root:
        return location(name, root)
    db, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}.versions"


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The rows of the last commit; a catalog table that was made otherwise is read from the catalog."""
    if root:
        return versions.read(spark, location(name, root))
    if spark.catalog.tableExists(name) and versions.current(spark, _home(spark, name, None)):
        return versions.read(spark, _home(spark, name, None))
    return spark.table(name)


def overwrite_table(df: DataFrame, name: str, schema: T.StructType | None = None, partition_by: Sequence[str] = (), root: str | None = None,
                    rebalance: bool = True, replace: Collection[tuple] | None = None, append: bool = False) -> versions.Commit:
    """Replace table ``name`` with ``df`` (Parquet), after checking the declared schema and adding its comments.

    Partitioned tables are written as one directory per partition value. Rows
    are clustered by the partition columns with a REBALANCE hint (unless
    ``df`` comes clustered: ``rebalance=False``), so each task writes few files
    while AQE still splits a partition value that holds a large share of the
    rows across several tasks. ``replace`` names the partitions to replace;
    all others keep their files. ``append`` adds the rows to the table.
    """
    if schema is not None:
        schemas.check(df, schema)
        df = schemas.commented(df)
    out = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    spark = df.sparkSession
    if append and not root:
        raise ValueError(f"{name}: the catalog holds one folder a table or partition; rows are added under a root path only")
    if not root:
        create_layers(spark, [name.partition(".")[0]] if "." in name else [])
    home = _home(spark, name, root)
    commit = versions.publish(out, home, partition_by, replace, append)
    if not root:
        _register(spark, name, home, commit)
    return commit


def _register(spark: SparkSession, name: str, home: str, commit: versions.Commit) -> None:
    """Make the catalog's entry show the commit, for SQL: no file is moved or read."""
    fields = T.StructType.fromJson(json.loads(commit.schema)).fields
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(f.metadata['comment'])}" if "comment" in f.metadata else "") for f in fields)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in commit.partition_by)})" if commit.partition_by else ""
    place = home if commit.partition_by else commit.paths(home)[0]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION {quoted(place)}")
    for part, held in sorted(commit.places.items()) if commit.partition_by else ():
        values = ", ".join(f"`{c}` = {quoted(v)}" for c, _, v in (x.partition("=") for x in part.split("/")))
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({values}) LOCATION {quoted(f'{home}/{held[0]}/{part}')}")
