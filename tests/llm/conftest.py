import duckdb
import pytest

from .odd import CLASH, DOC_SCHEMA, ODD_TEXTS

SF001 = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns of clashing names."""
    from pyspark.sql import functions as F

    rows = [(i, t, [None, "en", "de"][k % 3], [None, "s1", "s2", "s3"][k % 4], len(t or "")) for k, (i, t) in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, DOC_SCHEMA).withColumns({c: F.lit(c) for c in CLASH})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
