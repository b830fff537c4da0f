"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from quartermart.llm import stages
from quartermart.llm.decontaminate import leaked_items, with_leaks
from quartermart.llm.jaccard import near_groups
from quartermart.llm.language import label_languages
from quartermart.llm.line_dedup import dedup_lines
from quartermart.llm.mixing import mix
from quartermart.llm.nearest import nearest
from quartermart.llm.toxicity import judge_toxicity
from quartermart.llm.url_filter import judge
from quartermart.llm.warc import round_trip
from quartermart.llm.wordpiece import count_tokens

from .odd import ODD_TEXTS

N = len(ODD_TEXTS)


def test_mix(odd, none):
    rows = mix(odd).collect()
    assert len(rows) == N and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if not (r["text"] or "").split()} == {0}
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["size"] for r in rows), abs=32)
    assert rows[0]["removed"] == "removed" and mix(none).count() == 0


def test_line_dedup(odd, none):
    rows = dedup_lines(odd).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted((i or 0, t or "") for i, t in ODD_TEXTS)
    assert dedup_lines(none).count() == 0


def test_token_counts(odd, none):
    rows = count_tokens(odd).collect()
    by = {(r["doc_id"], r["text"]): (r["n_words"], r["n_tokens"]) for r in rows}
    assert len(rows) == N and by[1, None] == (0, 0) and by[3, " \t\n "] == (0, 0)
    assert by[6, "x" * 30_000] == (1, 1) and by[7, "a b c d e f " * 5000][0] == 30_000
    assert count_tokens(none).count() == 0


def test_language(odd, none):
    rows = label_languages(odd).collect()
    assert len(rows) == N and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 10)} == {"und"}
    assert label_languages(none).count() == 0


def test_decontaminate(spark, odd, none):
    bench = spark.createDataFrame([(1, "the same text as the other row has"), (2, None), (3, ""), (None, "a row without an id and five words")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in leaked_items(odd, bench).collect())
    assert got == [(0, 0), (8, 1), (8, 1), (9, 1)]
    assert with_leaks(odd, bench.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert leaked_items(none, bench).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (7, 1), (8, 0), (None, 1), (9, None), (6, 7)], "doc_id long, toxic int")
    rows = judge_toxicity(odd, labels).collect()
    assert len(rows) == N and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3, 10)} == {0.0}
    assert {r.score for r in judge_toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert judge_toxicity(none, labels).count() == 0


def test_jaccard(odd, none):
    rows = near_groups(odd).collect()
    assert len(rows) == N
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (8, 9)} == {(8, 8), (9, 8)}
    assert {r.n_shingles for r in rows if r.doc_id in (1, 2, 3, 10)} == {0}
    assert {r.n_shingles for r in rows if r.doc_id == 7} == {6} and {r.n_shingles for r in rows if r.doc_id == 6} == {1}
    assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    assert near_groups(none).count() == 0


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]),
            (3, [-1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, []), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (120, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"vec": F.lit(1), "rank": F.lit(2), "n": F.lit(3)})
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 120, 0.0), (0, 4, 3, -1.0),
                   (120, 1, 1, 1.0), (120, 2, 2, 1.0), (120, 3, 0, 0.0), (120, 4, 3, 0.0)]
    assert nearest(df.limit(0)).count() == 0


def test_warc(spark):
    long = "ü" * 600
    rows = [(1, "http://a/", long), (5, None, long), (5, "http://b/\n x", long), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (None, "u", long),
            (7, "u", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "size": F.lit(1), "value": F.lit(1)})
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in round_trip(df).collect())
    assert got == [(0, 1200, "revisit", 5), (1, 1200, "revisit", 5), (3, 5, "response", None), (4, 5, "response", None), (5, 1200, "response", None),
                   (5, 1200, "response", None), (6, 0, "response", None), (7, 300_000, "response", None)]
    assert round_trip(df.limit(0)).count() == 0


def test_url_filter(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (3, "http://X.Example.NET/en/a?b", None), (4, "http://example.net", None), (5, "http://a.example.com/de/", None),
            (6, "http://org/fr/x#y", None), (7, "http://norg/fr/x", None), (8, "http://q.org/fr", None), (8, "http://q.org/fr", None), (9, "a://net/?x", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"rule": F.lit(1), "host": F.lit(1), "node": F.lit(1)})
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in judge(df).collect())
    assert got == [(1, "", "", "", "allow"), (2, "", "", "", "allow"), (3, "x.example.net", "/en/a", "example.net/en/", "allow"),
                   (4, "example.net", "", "", "allow"), (5, "a.example.com", "/de/", "example.com/de/", "block"), (6, "org", "/fr/x", "org/fr/", "allow"),
                   (7, "norg", "/fr/x", "", "allow"), (8, "q.org", "/fr", "", "allow"), (8, "q.org", "/fr", "", "allow"), (9, "net", "/", "net/", "block")]
    assert judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [stages.keep_known_language, stages.drop_repeated_lines, stages.keep_one_of_group, stages.drop_leaks])
def test_stages_keep_the_columns(spark, odd, none, stage):
    out = stage(spark, odd, SF001)
    assert out.columns == odd.columns and {r["leaks"] for r in out.collect()} <= {"leaks"}
    assert stage(spark, none, SF001).count() == 0


def test_one_of_group_on_odd_rows(spark, odd):
    rows = stages.keep_one_of_group(spark, odd, None).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11]


def test_last_stage(spark, odd, none):
    rows = stages.mix_sources(spark, odd, None).collect()
    assert all(len(r.text.split()) == r.n_words and r.n_chars == len(r.text) for r in rows)
    assert stages.mix_sources(spark, none, None).count() == 0
