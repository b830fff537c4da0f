"""Toxicity: ids beside nulls, repeated labelled ids, long texts; models reach executors without the package."""

import os
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from quartermart.llm import decontaminate as D
from quartermart.llm import toxicity as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORDS = ["tree", "river", "stone", "cloud", "field"]


def text_of(i, n, extra=""):
    return " ".join(WORDS[(i * 7 + k * (1 + i % 3)) % 5] for k in range(n)) + extra


def model_of(spark):
    rows = [(i, text_of(i, 60, " you vile scum" if i % 2 else ""), i % 2) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return T.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), train_docs=40)


def plain_score(model, text):
    """The largest logit over every window, one window at a time."""
    net, slope, offset = model
    words = text.split()
    if not words:
        return 0.0, 0
    best, starts = -np.inf, T.window_starts(len(words))
    for at in starts:
        part = words[at:at + T.WINDOW]
        proj = net.project(net.features(T.Words.of([(0, [0])] + [T.word_keys(w) for w in part]))).reshape(len(part) + 1, 2, -1)
        rows = np.zeros((1, T.WINDOW), np.int64)
        rows[0, :len(part)] = np.arange(1, len(part) + 1)
        best = max(best, float(net.logits(proj, rows, (rows > 0).astype(np.float32))[0]))
    return 1 / (1 + np.exp(-np.clip(slope * best + offset, -60, 60))), len(starts)


def test_scores_equal_one_window_at_a_time(spark):
    model = model_of(spark)
    texts = ["", "one", text_of(1, 39), text_of(2, 40), text_of(3, 41), text_of(4, 500, " you vile scum " + text_of(5, 71)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in T.score(docs, model).collect():
        score, n = plain_score(model, texts[r.doc_id] or "")
        assert r.n_windows == n and abs(r.score - score) < 1e-4


def test_large_ids_beside_a_null_are_kept(spark):
    ids = [(1 << 60) + 1, None, (1 << 60) + 3]
    docs = spark.createDataFrame([(i, "some text") for i in ids], "doc_id long, text string").coalesce(1)
    for model in (model_of(spark), None):
        assert {r.doc_id for r in T.score(docs, model).collect()} == set(ids)


def test_pieces_of_a_long_text_share_one_grid_of_windows(spark):
    n = T._PIECE * T.STRIDE + 3 * T.WINDOW + 5
    docs = spark.createDataFrame([(1, text_of(1, n)), (2, text_of(1, 99_995))], "doc_id long, text string")
    got = {r.doc_id: r.n_windows for r in T.score(docs, model_of(spark)).collect()}
    assert got == {1: len(T.window_starts(n)), 2: len(T.window_starts(99_995))}


def test_a_repeated_id_is_learnt_once(spark, monkeypatch):
    rows = [(i % 8, f"text {i}") for i in range(400)]
    seen = []
    monkeypatch.setattr(T, "train", lambda texts, y, share: seen.append((texts, y.tolist())))
    T.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int"))
    texts, y = seen[0]
    assert texts == [min(t for j, t in rows if j == i) for i in range(8)] and y == [i % 2 for i in range(8)]


def test_names_are_told_by_the_whole_benchmark(spark):
    items = spark.createDataFrame([(1, "the big Rose met the old Rose near a small house by the lake in spring"),
                                   (2, "they saw a rose and a stone and some other things on that long day")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the big Tulip met the old Tulip near a small house by the lake in spring")], "doc_id long, text string")
    whole = [tuple(r) for r in D.leaked_items(docs, items).collect()]
    for size in (400, 80, 40, 20):
        found = D.with_leaks(docs, items, slice_bytes=size).select("doc_id", F.inline("leaks"))
        assert sorted(tuple(r) for r in found.collect()) == sorted(whole)


def test_models_reach_workers_that_lack_the_package(tmp_path):
    """The driver alone has the package on its path; workers start elsewhere and import nothing of it."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from quartermart.session import build_session
spark = build_session("local[2]", 2)
from pyspark.sql import functions as F
from quartermart.llm import toxicity as T, wordpiece as W, decontaminate as D
docs = spark.createDataFrame([(1, "some plain words of a text")], "doc_id long, text string")
probe = spark.range(1).select(F.udf(lambda _: __import__("importlib.util", fromlist=["util"]).find_spec("quartermart") is None, "boolean")("id")).first()[0]
labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
model = (T.Network(), 1.0, 0.0)
print("lacks", probe, T.score(docs, model).count(), W.count_tokens(docs).first().n_words,
      len(D.leaked_items(docs, docs.withColumnRenamed("doc_id", "item_id")).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "lacks True 1 6 1" in run.stdout, run.stdout + run.stderr[-3000:]
