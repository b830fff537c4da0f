"""Repeated passages of words, wherever lines begin and end (used by operator 2 and the pipeline).

A word goes if it lies in a run of ``n`` words (a window) that also stands at
an earlier place of the corpus (smallest doc_id, null ids last, then place in
the text); white space between words doesn't matter. Passages of ``n`` words
and more are thus found whole, and their first occurrence stays.

Every window has a key, the lowest hash among its runs of ``n // 2`` words, so
equal windows have equal keys; neighbouring windows of one key form a segment.
Segments whose key occurs once can't hold a repeated window: a first pass counts
the keys alone (8 bytes each), a bitmap of fixed size holds those that occur
twice, and a second pass writes only the segments it lets through. Of equal
segments all but the first go. No text is shuffled: a third pass finds the places
where single windows are compared by another bitmap, counts those windows, and a
fourth writes the ones that may occur twice. Only where one key has different segments (at the ends
of passages) single windows are compared. Words, segments and windows are
compared by 128 bits of hash. Nothing pairs the members of a group.

Defined results: null and empty texts, and those of fewer than ``n`` words, have
no repetition; rows that repeat both id and text are one document; an empty
table gives an empty result; no other columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from .common import WORD, bitmap_of, drop_table, in_bitmap, write_table
from .shingles import mix

_MEMO = 200_000
_FLUSH = 200_000  # words handled at once, or one text
#: Classes of keys in the bitmap, as a power of two: 8 MB. Beyond some 50 million repeated keys more segments pass.
KEY_BITS = 26
_BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_INVERSE = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


class Words:
    """128-bit ids of words, with a bounded memory of words seen."""

    def __init__(self):
        self.memo: dict[bytes, bytes] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """(words, 2) ids."""
        memo = self.memo
        if len(memo) > _MEMO:
            memo.clear()
        for w in set(words):
            if w not in memo:
                memo[w] = hashlib.blake2b(w, digest_size=16).digest()
        return np.frombuffer(b"".join(map(memo.__getitem__, words)), "<u8").reshape(-1, 2)


class Runs:
    """Hashes of any runs of the words ``ids``, from prefix sums modulo 2^64."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.back = [], []
        for k in (0, 1):
            power = np.cumprod(np.full(len(ids), _BASES[k], np.uint64))
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(ids[:, k] * power, dtype=np.uint64))))
            self.back.append(np.cumprod(np.full(len(ids) + 1, _INVERSE[k], np.uint64)))

    def __call__(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        return mix((self.sums[k][end] - self.sums[k][start]) * self.back[k][start])


def _lowest(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _keys(ids: np.ndarray, n: int, run: Runs) -> np.ndarray:
    """The key of the window at every word of ``ids``."""
    k = n // 2
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    return _lowest(run(np.arange(len(ids) - k + 1), np.arange(k, len(ids) + 1), 0), n - k + 1)


def _twice(windows: int, n: int, run: Runs) -> np.ndarray:
    """Whether the window at a word is equal to a later one that may be in its segment."""
    every = np.arange(windows)
    whole = run(every, every + n, 1)
    twice = np.zeros(windows, bool)
    for d in range(1, min(n - n // 2 + 1, windows)):  # windows that share a run of n // 2 words, at most
        twice[:-d] |= whole[:-d] == whole[d:]
    return twice


def _segment_starts(key: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows that lie in one text, which of them start a segment)."""
    at = np.arange(len(key))
    at = at[at + n <= ends[np.searchsorted(ends, at, "right")]] if len(at) else at
    if not len(at):
        return at, at
    new = np.concatenate(([True], (key[at[1:]] != key[at[:-1]]) | (at[1:] != at[:-1] + 1)))
    place = np.arange(len(at))
    return at, np.flatnonzero(new | ((place - np.maximum.accumulate(np.where(new, place, 0))) % (n - n // 2 + 1) == 0))


def segments(ids: np.ndarray, ends: np.ndarray, n: int, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Segments of texts that lie one after another in ``ids`` and end at ``ends``: first and last window, key, hashes.

    ``twice``: whether two windows of the segment may be equal. ``wanted`` says which keys' segments are.
    """
    run = Runs(ids)
    key = _keys(ids, n, run)
    twice = _twice(len(key), n, run)
    at, first = _segment_starts(key, ends, n)
    if not len(at):
        return {c: np.zeros(0, np.int64) for c in ("lo", "hi", "key", "h0", "h1", "twice")}
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1]
    own_twice = np.logical_or.reduceat(twice[at], first)
    if wanted:
        keep = wanted(key[lo])
        lo, hi, own_twice = lo[keep], hi[keep], own_twice[keep]
    return {"lo": lo, "hi": hi, "key": key[lo].view(np.int64), "h0": run(lo, hi + n, 0).view(np.int64), "h1": run(lo, hi + n, 1).view(np.int64),
            "twice": own_twice}


def _split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _pieces(texts: pa.Array, n: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """(words, ends of the texts in them, which texts) of the texts with ``n`` words and more, many at once."""
    words, ends, which = [], [], []
    for k in range(0, len(texts), 256):
        for i, text in enumerate(texts[k:k + 256].to_pylist(), k):
            ws = _split(text)
            if len(ws) >= n:
                words += ws
                ends.append(len(words))
                which.append(i)
            if len(words) >= _FLUSH:
                yield words, ends, which
                words, ends, which = [], [], []
    if words:
        yield words, ends, which


def _key_rows(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Words()
        for batch in batches:
            for words, ends, _ in _pieces(batch.column("text"), n):
                ids = ids_of(words)
                run = Runs(ids)
                key = _keys(ids, n, run)
                at, first = _segment_starts(key, np.array(ends), n)
                if not len(at):
                    continue
                # a segment that may hold equal windows counts twice
                count = 1 + np.logical_or.reduceat(_twice(len(key), n, run)[at], first)
                found, place = np.unique(key[at[first]], return_inverse=True)
                yield pa.RecordBatch.from_pydict({"key": found.view(np.int64), "n": np.minimum(np.bincount(place, count), 2).astype(np.int8)})

    return rows


def _named(batch: pa.RecordBatch, rows: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """doc_id and _fp of ``rows``, and other columns."""
    own = batch.select(["doc_id", "_fp"]).take(pa.array(rows))
    return pa.RecordBatch.from_arrays([*own.columns, *map(pa.array, columns.values())], ["doc_id", "_fp", *columns])


def _segment_rows(n: int, often) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Words()
        bitmap, bits = often.value
        for batch in batches:
            for words, ends, which in _pieces(batch.column("text"), n):
                ends = np.array(ends)
                found = segments(ids_of(words), ends, n, lambda key: in_bitmap(bitmap, bits, key))
                if not len(found["lo"]):
                    continue
                own = np.searchsorted(ends, found["lo"], "right")
                start = np.concatenate(([0], ends[:-1]))[own]
                found["lo"], found["hi"], found["twice"] = found["lo"] - start, found["hi"] - start, found["twice"].astype(bool)
                yield _named(batch, np.array(which)[own], **found)

    return rows


def spots(texts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit class of a place in a text, which is given by the first eight bytes of its fingerprint."""
    with np.errstate(over="ignore"):
        return mix(texts + places.astype(np.uint64) * _BASES[0])


def _spot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of the texts and of the segments' places in them: what a second reading looks for."""
    for b in batches:
        texts = np.array([int.from_bytes(x[:8], "little") for x in b.column("_fp").to_pylist()], np.uint64)
        lo = b.column("lo").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((mix(texts), spots(texts, lo))).view(np.int64))], ["spot"])


def _window_rows(n: int, heads, often=None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Single windows of the segments that start at the places ``heads`` (a few others may come along).

    Without ``often`` only how often (twice at most) a window's first hash occurs; with it the windows it lets through.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Words()
        bitmap, bits = heads.value
        for batch in batches:
            prints = np.array([int.from_bytes(x[:8], "little") for x in batch.column("_fp").to_pylist()], np.uint64)
            some = np.flatnonzero(in_bitmap(bitmap, bits, mix(prints)))
            texts = batch.column("text").take(pa.array(some))
            for words, ends, which in _pieces(texts, n):
                ids, ends = ids_of(words), np.array(ends)
                run = Runs(ids)
                at, first = _segment_starts(_keys(ids, n, run), ends, n)
                if not len(at):
                    continue
                own = np.searchsorted(ends, at, "right")
                local = at - np.concatenate(([0], ends[:-1]))[own]
                row = some[np.array(which)[own]]
                head = in_bitmap(bitmap, bits, spots(prints[row[first]], local[first]))
                keep = np.repeat(head, np.diff(np.append(first, len(at))))
                at, local, row = at[keep], local[keep], row[keep]
                h0 = run(at, at + n, 0)
                if often is None:
                    found, count = np.unique(h0, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"h0": found.view(np.int64), "n": np.minimum(count, 2).astype(np.int8)})
                    continue
                keep = in_bitmap(*often.value, h0)
                if keep.any():
                    at = at[keep]
                    yield _named(batch, row[keep], lo=local[keep], h0=h0[keep].view(np.int64), h1=run(at, at + n, 1).view(np.int64))

    return rows


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges in order, those that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def without(text: str, lines: list[tuple[int, int]], words: list[tuple[int, int]]) -> str:
    """``text`` without line ranges and word ranges; a word goes with the white space after it."""
    t = text + "\n"
    at = [0, *(m.end() for m in re.finditer("\n", t))]
    spans = [m.start() for m in re.finditer(WORD, text)] + [len(text)] if words else []
    left, done = [], 0
    for a, b in merged([(at[a], at[b]) for a, b in lines] + [(spans[a], spans[b]) for a, b in words]):
        left.append(t[done:a])
        done = b
    return "".join([*left, t[done:]]).removesuffix("\n")


def repeated_words(docs: DataFrame, n: int) -> DataFrame:
    """(_doc, _words: word ranges [start, end) that repeat an earlier passage) for ``docs`` (doc_id, _fp, text).

    ``_fp`` is a fingerprint of the text, ``_doc`` the struct of doc_id and ``_fp``, which names a document.
    """
    spark = docs.sparkSession
    send = lambda keys, key: spark.sparkContext.broadcast((bitmap_of(keys, key, KEY_BITS), KEY_BITS))
    named = lambda more: T.StructType([docs.schema["doc_id"], docs.schema["_fp"], *T.StructType.fromDDL(more)])
    flat = docs.select("doc_id", "_fp", "text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_fp", "lo")
    keys = flat.select("text").mapInArrow(_key_rows(n), "key long, n byte").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    found = write_table(flat.mapInArrow(_segment_rows(n, send(keys, "key")), named("lo long, hi long, key long, h0 long, h1 long, twice boolean"))
                        .withColumn("place", place).drop("doc_id", "_fp", "lo"), "passage-segments")
    same = ["key", "h0", "h1"]
    first = write_table(found.groupBy(*same).agg(F.min("place").alias("first"), F.count("*").alias("n"), F.max("twice").alias("twice")),
                        "passage-first")
    again = first.where("n > 1").select(*same, F.col("first").alias("start"))
    copies = found.join(again, same).where(F.col("place") != F.col("start")).select("place", (F.col("hi") + n).alias("end"))
    kinds = first.groupBy("key").agg(F.count("*").alias("n"), F.max("twice").alias("t")).where("n > 1 or t").select("key")
    heads = first.join(kinds, "key", "left_semi").select("first._fp", "first.lo").mapInArrow(_spot_rows, "spot long")
    places = send(heads, "spot")
    windows = flat.mapInArrow(_window_rows(n, places), "h0 long, n byte").groupBy("h0").agg(F.sum("n").alias("n")).where("n > 1")
    single = write_table(flat.mapInArrow(_window_rows(n, places, send(windows, "h0")), named("lo long, h0 long, h1 long"))
                         .withColumn("place", place).drop("doc_id", "_fp", "lo"), "passage-windows")
    least = single.groupBy("h0", "h1").agg(F.min("place").alias("start"), F.count("*").alias("n")).where("n > 1").drop("n")
    more = single.join(least, ["h0", "h1"]).where(F.col("place") != F.col("start")).select("place", (F.col("place.lo") + n).alias("end"))
    gone = copies.union(more).groupBy(F.struct("place.doc_id", "place._fp").alias("_doc")).agg(
        F.collect_set(F.struct("place.lo", "end")).alias("_r"))  # at most a document's windows

    @F.pandas_udf("array<struct<start: long, end: long>>")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ranges in batches:
            yield pd.Series([[{"start": a, "end": b} for a, b in merged([(int(r["lo"]), int(r["end"])) for r in rs])] for rs in ranges], dtype=object)

    out = write_table(gone.select("_doc", joined("_r").alias("_words")), "passage-words")
    for done in (found, first, single):
        drop_table(done)
    return out
