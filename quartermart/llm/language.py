"""Operator 4: language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3
letters, word ends included) over a bounded sample of labelled documents. A
document's own list is compared to every profile by out-of-place distance:
the sum over its n-grams of how far their ranks differ, with the list length
for an n-gram the profile lacks. The nearest profile wins, ties to the smaller
language code. The score is one less the distance's share of the largest
possible distance.

Defined results: a null text or one without letters is ``und`` with score 0, as
is every text when nothing was learnt; ties in frequency go to the smaller
n-gram; repeated rows are judged alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import held_out, pack, unpack

PROFILE_SIZE = 300
#: Expected number of labelled documents a language's profile is learnt from, at most.
SAMPLE_DOCS = 1500
UNKNOWN = "und"
_BITS = 21  # of a code point; a key holds up to three


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return table


def _grams(text: str, letters: np.ndarray) -> np.ndarray:
    """Keys of all n-grams of the words of ``text``; a word's ends count as one blank each."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.where(letters[codes], codes, 0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    a, b = codes[:-1], codes[1:]
    two = (2 << 2 * _BITS) | (a << _BITS) | b  # no letter has code 1 or 2
    mid = codes[1:-1] != 0
    three = (codes[:-2] << 2 * _BITS | codes[1:-1] << _BITS | codes[2:])[mid]
    one = codes[codes != 0] | (1 << 2 * _BITS)
    return np.concatenate((one, two, three)) if len(one) else one


def _ranked(text: str | None, letters: np.ndarray, size: int) -> np.ndarray:
    keys, counts = np.unique(_grams(text or "", letters), return_counts=True)
    return keys[np.argsort(-counts, kind="stable")[:size]]


def learn(labelled: DataFrame, profile_size: int = PROFILE_SIZE, sample_docs: int = SAMPLE_DOCS) -> dict[str, np.ndarray]:
    """Profiles, ranked n-gram keys by language, from ``labelled`` (doc_id, text, lang).

    A language with more rows than ``sample_docs`` gives each row with the
    probability that leaves about so many, decided by a hash of its id. Row
    numbers (one a language) are broadcast, so texts aren't dealt out by
    language; only the finished profiles, ``profile_size`` keys a language,
    reach the driver.
    """
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    n = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    sample = rows.join(F.broadcast(n), "lang").where(draw * F.col("_n") < sample_docs).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                keys, counts = np.unique(np.concatenate([_grams(t, letters) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": keys, "n": counts})

    order = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
           .withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile_size))
    found = top.select("lang", "gram", "place").toPandas().sort_values(["lang", "place"])
    return {lang: f["gram"].to_numpy() for lang, f in found.groupby("lang")}


def with_language(docs: DataFrame, profiles: dict[str, np.ndarray], profile_size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with ``found``: struct(lang_pred, score, runner_up) for ``text``."""
    langs = sorted(profiles)
    known = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.zeros(0, np.int64)
    ranks = np.full((len(known), len(langs)), -1, np.int64)  # -1: not in that profile
    for j, x in enumerate(langs):
        ranks[np.searchsorted(known, profiles[x]), j] = np.arange(len(profiles[x]))
    model = docs.sparkSession.sparkContext.broadcast((langs, known, ranks))  # profile_size rows a language

    @F.pandas_udf("lang_pred string, score double, runner_up string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        langs, known, ranks = model.value
        for texts in batches:
            out = []
            for text in texts:
                own = _ranked(text, letters, profile_size)
                if not len(own) or not langs:
                    out.append((UNKNOWN, 0.0, None))
                    continue
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                place = np.where((known[at] == own)[:, None], ranks[at], -1)
                far = np.where(place >= 0, np.abs(place - np.arange(len(own))[:, None]), profile_size).sum(axis=0)
                best = np.argsort(far, kind="stable")
                out.append((langs[best[0]], float(1 - far[best[0]] / (profile_size * len(own))), langs[best[1]] if len(langs) > 1 else None))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "runner_up"])

    return unpack(pack(docs, "text").withColumn("found", judge.asNondeterministic()(F.col("text"))), docs.columns, ["text"], ["found"])


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], profile_size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, lang_pred, score, runner_up), one row for each row."""
    return with_language(docs.select("doc_id", "text"), profiles, profile_size).select("doc_id", "found.*")


def label_languages(docs: DataFrame) -> DataFrame:
    """Learn from the rows not held out, then predict every row; adds ``held_out``."""
    profiles = learn(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, profiles).withColumn("held_out", held_out(F.col("doc_id")))
