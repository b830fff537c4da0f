"""Phrase mining against a plain count of everything."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quartermart.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, min_count, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    out = []
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    inside = {}
    for (lang, w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside.get((lang, w[i:j]), 0), a)
    for (lang, w), a in candidates.items():
        if inside.get((lang, w), 0) < a:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, " ".join(w), a, left, right, n[lang], score))
    ranked, at = [], Counter()
    for r in sorted(out, key=lambda r: (r[0].encode(), -r[6], -r[2], r[1].encode())):
        at[r[0]] += 1
        if at[r[0]] <= top:
            ranked.append((r[0], at[r[0]], *r[1:]))
    return sorted(ranked)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "of", "é", "日本", "a\x01", "z9", "-"]
    rows = []
    for i in range(n):
        text = "".join(rng.choices(words, weights=range(len(words), 0, -1))[0] + rng.choice([" ", " ", "  ", "\t", ". ", "\n", " "]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return [*rows, (-1, None, "en"), (-2, "", None), (-3, " . \t", "fr"), (-4, "the of " * 400, "en")]


@pytest.mark.parametrize(("min_count", "bits", "splits"), [(3, 20, 1), (2, 10, 40), (7, 8, 200), (300, 12, 8)])
def test_equals_the_plain_count_however_the_streams_are_split(spark, min_count, bits, splits):
    rows = corpus(min_count)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", splits)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(map(tuple, P.collocations(docs, min_count=min_count, top=40, bits=bits).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = plain([r[1:] for r in rows], min_count, 40)
    assert got == want and len(got) > (5 if min_count < 300 else 0)


def test_one_phrase_in_a_third_of_all_rows_and_copies(spark):
    rows = [(i, "hot words stay together" if i % 3 == 0 else f"cold {i % 5} words", None) for i in range(300)]
    got = sorted(map(tuple, P.collocations(spark.createDataFrame(rows, SCHEMA), min_count=20).collect()))
    assert got == plain([r[1:] for r in rows], 20, 2000) and ("und", 1, "hot words stay together") == got[0][:3]


def test_products_beyond_64_bits(spark):
    a, n = 3 * 10**12, 4 * 10**17
    counts = spark.createDataFrame([("x", ["p"], 5 * 10**12), ("x", ["q"], 7 * 10**12), ("x", ["p", "q"], a)], "grp string, words array<string>, f long")
    totals = spark.createDataFrame([("x", n)], "grp string, n long")
    got = P.scored(counts, totals).collect()
    assert [r.score for r in got] == [1000 * a * n // (5 * 10**12 * 7 * 10**12)]


def test_odd_rows_and_empty_table(spark, odd, none):
    docs = odd.withColumns({"grp": F.lit("c"), "phrase": F.lit("c"), "words": F.lit("c")})
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert sorted(map(tuple, P.collocations(docs, min_count=2).collect())) == plain(rows, 2, 2000)
    assert P.collocations(none).collect() == []
