"""Distinct counts by bitmaps: equal to plain distinct counts, mergeable, fewer rows moved."""

import pytest
from pyspark.sql import functions as F

from quartermart.operators import bitmaps as B

SCHEMA = "g string, h string, k string, v long"


def written(spark, df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@pytest.fixture
def rows(spark):
    hot = [("hot", "x", f"u{i % 700}", 1) for i in range(3000)]         # a third of all rows in one group
    spread = [(f"g{i % 13}", "xy"[i % 2], f"u{i * 31 % 5000}", i) for i in range(6000)]
    odd = [("hot", "x", None, 1), (None, None, "u1", 5), ("only null", "y", None, 7), ("hot", "x", "u1", 1)]
    return spark.createDataFrame([*hot, *spread, *odd], SCHEMA)


def test_counts_equal_distinct_counts_and_merge(spark, rows, tmp_path):
    numbers = written(spark, B.number(rows, "k", "no"), tmp_path, "numbers")
    assert numbers.select("no").distinct().count() == numbers.count() == rows.select("k").distinct().count() - 1
    df = rows.join(numbers, "k", "left")
    state = written(spark, B.presence(df, ["g", "h"], {"user": "no"}, {"n": F.lit(1), "s": F.col("v")}), tmp_path, "state")
    for group in (["g", "h"], ["g"], ["h"]):
        got = B.counts(state if len(group) == 2 else B.merged(state, group, ["n", "s"]), group, {"user": "users"}, ["n", "s"])
        want = rows.groupBy(*group).agg(F.countDistinct("k").alias("users"), F.count("*").alias("n"), F.sum("v").alias("s"))
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_numbers_are_dense_and_follow_the_order(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", i % 3) for i in range(1000)], "k string, q int")
    numbers = written(spark, B.number(df, "k", "no", order=["q"]), tmp_path, "n").collect()
    place = {r.k: r.no for r in numbers}
    by_order = sorted(place, key=lambda k: (int(k[1:]) % 3, k))
    assert sorted(place.values()) == [place[k] for k in by_order]
    assert len({n // 32768 for n in place.values()}) <= 8               # one bitmap a range, not one a key


def test_an_empty_table_has_no_state(spark, rows):
    none = rows.where("1 = 0").withColumn("no", F.lit(1).cast("long"))
    assert B.presence(none, ["g"], {"user": "no"}, {"n": F.lit(1)}).collect() == []


def test_place_state_moves_fewer_rows_than_the_expand(spark, tmp_path):
    """What is shuffled is bounded by groups and tasks, not by visits: as many rows for three times the visits."""
    from conftest import SF001

    from quartermart import catalog as C
    from quartermart.plans import presence

    visits = presence.numbered(C.fact(spark, SF001), lambda df, name: written(spark, df, tmp_path, name))
    once, thrice = (presence.place_state(v) for v in (visits, visits.union(visits).union(visits)))
    assert once.count() == thrice.count()
    users = presence.attraction_counts(thrice)
    plain = C.fact(spark, SF001).groupBy("poi_id").agg(F.countDistinct("blog_id").alias("n"))
    assert users.agg(F.sum("visit_total_cnt")).first()[0] == 3 * visits.count()
    state = presence.counts_over(thrice, ["poi_id"]).select("poi_id", F.col("visit_user_cnt").alias("n"))
    assert state.exceptAll(plain).count() == 0 == plain.exceptAll(state).count()


def test_sparse_groups_take_no_more_than_a_word_a_row(spark):
    """Groups with a few numbers far apart: the state grows with the rows, not by a wide bitmap for each of them."""
    far = spark.range(3000).select((F.col("id") % 500).cast("string").alias("g"), F.shiftleft(F.col("id") * 7919, 16).alias("no"))
    state = B.presence(far, ["g"], {"user": "no"}, {"n": F.lit(1)})
    size = state.agg(F.sum(F.octet_length(F.col("bits").cast("string")))).first()[0]
    assert size <= 3000 * 20      # the digits of a long
    got = B.counts(state, ["g"], {"user": "users"}, ["n"]).select("users", "n").distinct().collect()
    assert [(r.users, r.n) for r in got] == [(6, 6)]
    top = spark.createDataFrame([("a", i) for i in (0, 62, 63, 64, 127, (1 << 33) * 9 + 63)], "g string, no long")
    assert B.counts(B.presence(top, ["g"], {"user": "no"}, {"n": F.lit(1)}), ["g"], {"user": "users"}, ["n"]).first()["users"] == 6
