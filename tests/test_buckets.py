"""Bucketed tables: fewer exchanges, same rows, all-or-nothing writes, empty tables."""

import pytest
from conftest import SF001, SF01, poi_df, visits_df
from pyspark.sql import functions as F

from quartermart import catalog as C
from quartermart.plans import warehouse as W
from quartermart.plans.portrait import user_portrait
from quartermart.plans.user_quarter import user_quarter
from quartermart.sources import binding, buckets, schemas, sinks


@pytest.fixture(autouse=True)
def plain_plans(spark):
    yield
    for t in spark.catalog.listTables("default"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange " in line and "BroadcastExchange" not in line and "Reused" not in line]


def small(spark):
    visits = visits_df(spark, [(f"u{i % 7}", f"2015-0{1 + i % 9}-11", "Solo" if i % 2 else "Friends", f"p{i % 4}") for i in range(120)])
    return visits, poi_df(spark, [("p0", "A", "c1", "r1"), ("p1", "B", "c2", "r1"), ("p2", None, None, "r2")])


def test_user_quarter_takes_one_exchange_and_portrait_none(spark, tmp_path):
    visits, dim = C.fact(spark, SF01), spark.createDataFrame(C.dim(spark, SF01).collect(), C.dim(spark, SF01).schema)
    buckets.write_bucketed(visits, "b_visits", ["trip_id"], 8, schemas.DWD_VISIT, W.MONTH_PARTITION, home=str(tmp_path / "v"))
    mart = user_quarter(spark.table("b_visits"), dim, broadcast=True)
    assert len(exchanges(mart)) == 1 and "REPARTITION_BY_COL" in exchanges(mart)[0]
    buckets.write_bucketed(mart, "b_mart", ["blog_id"], 8, schemas.DWS_USER_QUARTER, W.QUARTER_PARTITION, home=str(tmp_path / "m"))
    portrait = user_portrait(spark.table("b_mart"), clustered=True)
    assert exchanges(portrait) == []
    want = C.normalize(user_portrait(mart))
    got = C.normalize(portrait)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert len(exchanges(user_quarter(visits, dim, broadcast=True))) > 1


def test_files_of_a_bucket(spark, tmp_path):
    visits, _ = small(spark)
    buckets.write_bucketed(visits, "b_files", ["trip_id"], 4, partition_by=["travel_year"], home=str(tmp_path))
    assert buckets.bucket_spec(spark, "b_files") == (["trip_id"], 4)
    assert len(spark.table("b_files").inputFiles()) <= 4
    assert spark.table("b_files").select(*visits.columns).exceptAll(visits).count() == 0
    sinks.overwrite_table(visits, "b_plain")
    assert buckets.bucket_spec(spark, "b_plain") is None


def test_a_failed_write_keeps_the_old_table_and_old_folders_can_go(spark, tmp_path):
    visits, _ = small(spark)
    home = str(tmp_path)
    buckets.write_bucketed(visits, "b_safe", ["trip_id"], 4, home=home)
    with pytest.raises(Exception, match="broken off"):
        broken = visits.withColumn("travel_partners", F.when(F.col("poi_id") == "p3", F.raise_error(F.lit("broken off"))).otherwise(F.lit("x")))
        buckets.write_bucketed(broken, "b_safe", ["trip_id"], 4, home=home)
    assert spark.table("b_safe").count() == 120
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("b_safe__")]
    buckets.write_bucketed(visits.limit(5), "b_safe", ["trip_id"], 4, home=home)
    assert spark.table("b_safe").count() == 5
    assert buckets.drop_old(spark, "b_safe") >= 1 and spark.table("b_safe").count() == 5
    with pytest.raises(schemas.SchemaMismatch):
        buckets.write_bucketed(visits.drop("poi_id"), "b_safe", ["trip_id"], 4, schemas.DWD_VISIT, home=home)


def test_empty_and_null_keys(spark, tmp_path):
    visits, dim = small(spark)
    buckets.write_bucketed(visits.limit(0), "b_none", ["trip_id"], 4, home=str(tmp_path / "a"))
    assert spark.table("b_none").count() == 0 and user_quarter(spark.table("b_none"), dim, broadcast=True).count() == 0
    odd = visits.withColumn("trip_id", F.when(F.col("poi_id") != "p1", F.col("trip_id")))
    buckets.write_bucketed(odd, "b_null", ["trip_id"], 4, home=str(tmp_path / "b"))
    got, want = (C.normalize(user_quarter(v, dim, broadcast=True)) for v in (spark.table("b_null"), odd))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_all_layers_in_buckets(spark):
    tables = W.Tables(**{f: f"bk_{n}" for f, n in vars(W.Tables()).items()})
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE, buckets=4, tables=tables)
    W.load_ods(spark, C.ods_poi(spark, SF001), C.ods_trip(spark, SF001), cfg)
    W.run(spark, cfg)
    assert buckets.bucket_spec(spark, tables.dwd_visit) == (["trip_id"], 4) and buckets.bucket_spec(spark, tables.dws_user) == (["blog_id"], 4)
    for table, name in ((tables.dwd_visit, "visits_clean"), (tables.dws_user, "user_quarter"), (tables.ads_portrait, "user_portrait"),
                        (tables.dws_city, "city_quarter")):
        got, want = C.normalize(sinks.read_table(spark, table)), C.queries()[name](spark, SF001)
        assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0, name
    with pytest.raises(ValueError, match="root"):
        W.Config(buckets=4, root="/tmp/x")
