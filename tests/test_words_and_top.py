"""Rules by words against the CASE; top values from summaries against the full count."""

import random

import pytest
from conftest import SF001

from quartermart import catalog as C
from quartermart.functions.rules import DEFAULT_CATEGORY_RULES, CategoryRules
from quartermart.operators.profile import frequency
from quartermart.operators.top import candidates, top_frequency
from quartermart.operators.words import categories_by_words, plain_words

LETTERS = "ab湖山é"


def labels(spark, n=300, seed=1):
    r = random.Random(seed)
    rows = [(i, "".join(r.choice(LETTERS + ";") for _ in range(r.randint(0, 9)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "无标签"), (n + 3, "无标签" * 400 + "湖"), (n + 4, "a.b"), (n + 5, "a\\b'"), (n + 5, "a\\b'")]
    return spark.createDataFrame(rows, "id int, label_zh string")


def rules_of(seed, n, regexes=()):
    r = random.Random(seed)
    patterns = [(f"c{i}", "|".join("".join(r.choice(LETTERS) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 3)))) for i in range(n)]
    for at, rx in regexes:
        patterns.insert(at, (f"rx{at}", rx))
    return CategoryRules(patterns=tuple(patterns))


@pytest.mark.parametrize("rules", [
    rules_of(1, 3), rules_of(2, 12), rules_of(3, 5, [(0, "^a"), (3, "山.*湖")]), CategoryRules(patterns=()),
    CategoryRules(patterns=(("only", "a+b"),)), CategoryRules(patterns=(("quote", "b'"), ("empty", "a||b"))), DEFAULT_CATEGORY_RULES])
@pytest.mark.parametrize("how", [None, "split"])
def test_words_equal_the_case(spark, rules, how):
    df = labels(spark)
    want = sorted((r.id, r.category) for r in df.withColumn("category", rules.column("label_zh")).collect())
    got = categories_by_words(df, rules, broadcast=how)
    assert got.columns[-1] == "category" and set(got.columns) == {"id", "label_zh", "category"}
    assert sorted((r.id, r.category) for r in got.collect()) == want


def test_words_of_a_pattern():
    assert plain_words("ring|bolt") == ["ring", "bolt"] and plain_words("山") == ["山"]
    assert plain_words("a.c|b") is None and plain_words("") is None and plain_words("a|") is None


def test_five_thousand_rules(spark):
    """Every rule is one word of five letters; the CASE of so many can't be compiled, so Python is the measure."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijkl") for _ in range(5)) for _ in range(5000)]
    rows = [(i, "-".join(r.choice(words) if r.random() < 0.5 else "zzzzz" for _ in range(3))) for i in range(400)]
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    want = {i: min((first[w] for w in t.split("-") if w in first), default=None) for i, t in rows}
    rules = CategoryRules(patterns=tuple((f"c{i}", w) for i, w in enumerate(words)))
    got = categories_by_words(spark.createDataFrame(rows, "id int, label_zh string"), rules).collect()
    assert {r.id: r.category for r in got} == {i: rules.default if n is None else f"c{n}" for i, n in want.items()}


def test_no_rows(spark):
    df = labels(spark).where("1 = 0")
    assert categories_by_words(df, rules_of(1, 3)).count() == 0
    out, proven = top_frequency(df, "label_zh", 5)
    assert out.count() == 0 and proven and candidates(df, "label_zh") == []


@pytest.mark.parametrize("tracked, n, proven", [(10_000, 50, True), (40, 3, True), (2, 50, False), (1, 1, False)])
def test_top_values_equal_the_full_count(spark, tracked, n, proven):
    rows = [(f"h{i % 3}",) for i in range(900)] + [(f"x{i}",) for i in range(500)] + [(None,)] * 60
    df = spark.createDataFrame(rows, "v string").repartition(7)
    out, known = top_frequency(df, "v", n, tracked)
    assert [tuple(r) for r in out.collect()] == [tuple(r) for r in frequency(df, ["v"], n).collect()]
    assert known is proven


def test_ties_at_the_end_of_the_report(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", "c") for _ in range(10)] + [("z",)], "v string")
    for tracked in (1, 2, 3, 100):
        assert [r.v for r in top_frequency(df, "v", 2, tracked)[0].collect()] == ["a", "b"]


def test_tracked_is_bounded(spark):
    with pytest.raises(ValueError, match="can be tracked"):
        candidates(labels(spark), "label_zh", 10_001)


def test_test_data_is_proven(spark):
    assert top_frequency(C.skewed(spark, SF001), "poi_id", 50)[1]
