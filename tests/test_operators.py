"""Generic operators not on the main job path: top-N, rules, maps."""

from pyspark.sql import functions as F

from quartermart.functions.collect import keys_with_max, map_text, top_keys
from quartermart.functions.metrics import exact_mean, ratio
from quartermart.functions.rules import Box, CategoryRules, RegionRules, first_match
from quartermart.operators.join import persisted
from quartermart.operators.ranking import top_n


def test_top_n_per_group(spark):
    df = spark.createDataFrame([(g, f"i{i}", i % 4) for g in "ab" for i in range(10)], "g string, i string, v long")
    out = top_n(df, ["g"], "v", 3, ["i"]).collect()
    assert len(out) == 6
    assert sorted(r.i for r in out if r.g == "a") == ["i2", "i3", "i7"]   # 3, 3, then the first 2


def test_persisted_releases(spark):
    df = spark.range(10)
    with persisted(df) as d:
        assert d.count() == 10 and d.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_rules_and_collections(spark):
    rules = RegionRules(boxes=(Box("N", lat_min=40), Box("S", lat_at_most=20)), default="M")
    cats = CategoryRules(patterns=(("x", "a|b"),), no_label="-", unclassified="U", default="O")
    df = spark.createDataFrame([(45.0, "zzb"), (20.0, "-"), (30.0, "q")], "latitude double, label_zh string")
    got = [tuple(r) for r in df.select(rules.column(), cats.column()).collect()]
    assert got == [("N", "x"), ("S", "U"), ("M", "O")]
    col = first_match([(F.col("latitude") > 40, "hi")], None)
    assert [r[0] for r in df.select(col).collect()] == ["hi", None, None]
    m = spark.createDataFrame([({"a": 2, "b": 2, "c": 1},)], "m map<string,bigint>")
    row = m.select(top_keys("m").alias("t"), map_text("m").alias("s"),
                   keys_with_max(F.array(F.struct(F.lit(1).alias("value"), F.lit("x").alias("key")),
                                         F.struct(F.lit(1).alias("value"), F.lit("w").alias("key")))).alias("k")
                   ).first()
    assert row.t == ["a", "b"] and row.s == "a:2,b:2,c:1" and row.k == ["w", "x"]


def test_exact_mean_and_ratio(spark):
    df = spark.createDataFrame([(10050, 2, 1, 3), (0, 0, 2, 0), (4999, 1, 5, 7)], "s long, c long, a long, b long")
    got = [tuple(r) for r in df.select(exact_mean("s", "c"), ratio("a", "b")).collect()]
    assert got == [(0.5, 0.3333), (None, 0.0), (0.5, 0.7143)]
