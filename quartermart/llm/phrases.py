"""Operator 13: phrase collocations from sorted streams of counts.

1. Sketch. Every task counts the hashes of its n-grams (2 to 5 words, by group) in
   classes, one table for each length, capped at ``min_count``; the tables are added
   up. An n-gram can occur ``min_count`` times only if its class does, so the
   resulting bitmaps (a fixed number of bits) rule out most n-grams and no frequent one.
   Single words are counted without: the vocabulary is small beside the n-grams.
2. Counts. Every task numbers the words of its texts exactly, joins numbers to n-grams
   by sorting (an n-gram is its first words' number and its last word), leaves out those
   that the bitmaps rule out, and sends (group, phrase, count). Spark adds up; what
   occurs ``min_count`` times stays. Parts and extensions of a candidate that matter are
   themselves that frequent, so this stream holds every count that is needed.
3. Streams. The counts are kept in prefix order (by first word, then second, ...) and in
   suffix order (by last word, then the one before, ...). In prefix order the first
   parts of a phrase are the rows above it whose families it closes, so one pass that
   holds five rows merges the streams of all lengths in lockstep: it reads off the
   counts of first parts and, when a family ends, its best extension to the right.
   Suffix order gives the counts of last parts and extensions to the left in the same
   way. A stream is split by range; the at most four rows that a split continues are
   looked up and put in front of it, and best extensions of one phrase that come from
   several splits are merged with the two streams by a last sorted aggregate.

A phrase within any longer candidate as frequent as itself lies within one that is a
word longer and as frequent (counts never grow with the length), so extensions by one
word decide what is dropped.

Defined results: null or empty texts have no words; a null group is ``und``; repeated
rows count each; ties of the score go to the larger count, then to the phrase by UTF-8
bytes; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrow_words import byte_classes, words_of
from .common import write_table
from .shingles import Hasher, mix

MAX_WORDS, MIN_COUNT, TOP, SCALE = 5, 100, 2000, 1000
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Classes of the sketch for each length, as a power of two: 16 MB a length in a task, 2 MB a length in the bitmap.
#: In a corpus of so many n-grams that most classes reach the least count, more rows are counted; results stay the same.
CLASS_BITS = 24
#: Classes that travel together when the tasks' tables are added up.
_BLOCK_BITS = 16
_SLICE = 1 << 22
LENGTHS = MAX_WORDS - 1


def _pieces(b: pa.RecordBatch, kind: np.ndarray):
    """(words, group of each word, names of the groups) for pieces of a batch."""
    groups = b.column("grp").dictionary_encode()
    names, of_row = groups.dictionary.to_pylist(), groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for w in words_of(b.column("text"), kind, lower=True):
        if len(w.array):
            yield w, np.repeat(of_row[w.first:w.first + w.rows], np.diff(w.at)), names


def _classes(w, of_word: np.ndarray, names: list[str], hasher: Hasher, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 2 to 5: (places where an n-gram starts, their classes)."""
    hashes, _ = hasher.words(w.clean, w.offsets[1:-1])
    seeds = np.array([zlib.crc32(x.encode()) for x in names], np.uint64)
    at = np.arange(len(hashes))
    h = hashes + mix(seeds)[of_word]
    for m in range(2, MAX_WORDS + 1):
        keep = w.joined[at + m - 2]
        at = at[keep]
        with np.errstate(over="ignore"):
            h = h[keep] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + m - 1]
        yield at, (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(texts: DataFrame, min_count: int, bits: int) -> list[np.ndarray]:
    """For each length a bitmap of the classes that reach ``min_count``."""
    block = min(bits, _BLOCK_BITS)
    cap = min(min_count, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, hasher, tables = byte_classes(BLANKS, BREAKS), Hasher(), None
        for b in batches:
            for w, of_word, names in _pieces(b, kind):
                if tables is None:
                    tables = np.zeros((LENGTHS, 1 << bits), np.uint8)
                for table, (_, c) in zip(tables, _classes(w, of_word, names, hasher, bits), strict=True):
                    for lo in range(0, len(table), _SLICE):  # counted in slices that stay small
                        part = table[lo:lo + _SLICE]
                        n = np.bincount(c[(c >= lo) & (c < lo + _SLICE)] - lo, minlength=len(part))
                        n += part
                        part[:] = np.minimum(n, cap, out=n)
        if tables is not None:
            for m, table in enumerate(tables):
                for k, part in enumerate(table.reshape(-1, 1 << block)):
                    yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])],
                                                     ["m", "block", "part"])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a block's rows come one after the other
        at, total = None, None

        def bitmap():
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                                               pa.array([np.packbits(total >= cap).tobytes()])], ["m", "block", "bits"])

        for b in rows:
            for m, k, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (m, k) != at:
                    if at:
                        yield bitmap()
                    at, total = (m, k), np.zeros(1 << block, np.uint16)
                total = np.minimum(total + np.frombuffer(zlib.decompress(part), np.uint8), cap).astype(np.uint16)
        if at:
            yield bitmap()

    parts = texts.mapInArrow(count, "m int, block int, part binary").repartition("m", "block").sortWithinPartitions("m", "block")
    maps = [np.zeros((1 << (bits - block), (1 << block) // 8), np.uint8) for _ in range(LENGTHS)]
    for r in parts.mapInArrow(add, "m int, block int, bits binary").toLocalIterator():  # 4 * 2^bits bits in all
        maps[r.m][r.block] = np.frombuffer(r.bits, np.uint8)
    return [x.ravel() for x in maps]


def phrase_counts(docs: DataFrame, group: str, min_count: int = MIN_COUNT, bits: int = CLASS_BITS) -> tuple[DataFrame, DataFrame]:
    """(group, words, f) of all phrases of 1 to 5 words that occur ``min_count`` times, and (group, n) with the words of each group."""
    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN)).alias("grp"), "text")
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(texts, min_count, bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, hasher, maps = byte_classes(BLANKS, BREAKS), Hasher(), sketch.value
        schema = pa.schema([("grp", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
        for b in batches:
            for w, of_word, names in _pieces(b, kind):
                labels = pa.array(names, pa.string())
                n = np.bincount(of_word, minlength=len(names))
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([labels.take(pa.array(seen)), pa.nulls(len(seen), pa.string()), pa.array(n[seen])], schema=schema)
                coded = w.array.dictionary_encode()
                word, codes = coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                number, alive = of_word.copy(), np.ones(len(codes), bool)  # of the first words at each place; whether they may be frequent
                phrase, every = None, [(np.arange(len(codes)), None)]
                for m, (at, c) in enumerate(chain(every, _classes(w, of_word, names, hasher, bits))):
                    if m:
                        at, c = at[alive[at]], c[alive[at]]
                        at = at[(maps[m - 1][c >> 3] >> (7 - (c & 7)) & 1).astype(bool)]
                        alive = np.zeros(len(codes), bool)
                        alive[at] = True
                    keys, inverse, n = np.unique(number[at] << 32 | codes[at + m], return_inverse=True, return_counts=True)
                    first, last = keys >> 32, word.take(pa.array(keys & 0xFFFFFFFF))
                    if phrase is None:
                        phrase, of_phrase = last, first
                    else:
                        phrase = pc.binary_join_element_wise(phrase.take(pa.array(first)), last, pa.scalar(" ", pa.large_string()))
                        of_phrase = of_phrase[first]
                    number[at] = inverse
                    if len(keys):
                        for batch in pa.Table.from_arrays([labels.take(pa.array(of_phrase)), phrase.cast(pa.string()), pa.array(n)], schema=schema).to_batches(65536):
                            yield batch

    counted = texts.mapInArrow(count, "grp string, phrase string, n long").groupBy("grp", "phrase").agg(F.sum("n").alias("n"))
    counted = write_table(counted.where((F.col("n") >= min_count) | F.col("phrase").isNull()), "phrases")
    phrases = counted.where("phrase is not null").select("grp", F.split("phrase", " ").alias("words"), F.col("n").alias("f"))
    return phrases, counted.where("phrase is null").select("grp", "n")


def _chains(counts: DataFrame) -> DataFrame:
    """One pass over the stream of ``counts`` (grp, words, f) in the order of words.

    Per phrase: f, ``parts`` (counts of its first 1, 2, ... words, its own last) and ``longer``, the largest count of a
    phrase one word longer. A split may know ``longer`` of a phrase that stands in another; that comes as a row with null f and parts.
    """
    order = ["grp", "words"]
    stream = write_table(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("split", F.spark_partition_id()), "stream")
    heads = stream.groupBy("split").agg(F.min(F.struct(*order)).alias("first")).select("split", "first.*")
    heads = heads.where(F.size("words") > 1).select(
        "split", "grp", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.slice("words", F.lit(1), k))).alias("words"))
    above = stream.drop("split").join(heads, order).select("grp", "words", "f", "split", F.lit(False).alias("own"))
    splits = stream.withColumn("own", F.lit(True)).unionByName(above).repartition("split").sortWithinPartitions("split", *order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("grp", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()), ("parts", pa.list_(pa.int64())), ("longer", pa.int64())])
        place, open_, out = None, [], []  # open_: [words, f, own, longer] of the families that the current row is in

        def close(depth: int) -> None:
            while len(open_) > depth:
                words, f, own, longer = open_.pop()
                if own:
                    out.append((place[1], words, f, [x[1] for x in open_] + [f], longer))
                elif longer:
                    out.append((place[1], words, None, None, longer))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

        for b in batches:
            for grp, words, f, split, own in zip(*(b.column(c).to_pylist() for c in ("grp", "words", "f", "split", "own")), strict=True):
                if (split, grp) != place:
                    close(0)
                    place = (split, grp)
                depth = 0
                while depth < len(open_) and depth + 1 < len(words) and open_[depth][0] == words[:depth + 1]:
                    depth += 1
                close(depth)
                if open_:
                    open_[-1][3] = max(open_[-1][3], f)
                open_.append([words, f, own, 0])
            if len(out) > 20_000:
                yield batch()
                out.clear()
        close(0)
        if out:
            yield batch()

    return splits.select("grp", "words", "f", "split", "own").mapInArrow(walk, "grp string, words array<string>, f long, parts array<long>, longer long")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """All phrases of ``counts`` with two words and more that no longer one contains as often, with their lowest cut."""
    none = F.lit(None).cast("array<long>")
    left = _chains(counts).withColumnsRenamed({"parts": "firsts"}).withColumn("lasts", none)
    right = _chains(counts.withColumn("words", F.reverse("words")))
    right = right.select("grp", F.reverse("words").alias("words"), "f", none.alias("firsts"), F.col("parts").alias("lasts"), "longer")
    both = left.select(*right.columns).union(right).groupBy("grp", "words").agg(
        F.max("f").alias("a"), F.max("firsts").alias("firsts"), F.max("lasts").alias("lasts"), F.max("longer").alias("longer"))
    found = both.where((F.size("words") > 1) & (F.col("longer") < F.col("a"))).join(totals, "grp")
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  # a product of two has up to 38 digits
    scaled = wide(F.col("a") * F.lit(SCALE)) * wide(F.col("n"))
    first, last = (lambda k: F.element_at("firsts", k)), (lambda k: F.element_at("lasts", F.size("words") - k))
    cuts = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        F.call_function("div", F.col("scaled"), wide(first(k)) * wide(last(k))).alias("score"), k.alias("k"), first(k).alias("l"), last(k).alias("r")))
    found = found.withColumn("scaled", scaled).select("grp", F.array_join("words", " ").alias("phrase"), "a", "n", F.array_min(cuts).alias("cut"))
    return found.select("grp", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, group: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, bits: int = CLASS_BITS) -> DataFrame:
    """Each group's first ``top`` phrases by score: grp, rank, phrase, a, l, r, n, score (whole numbers, exact)."""
    rank = F.row_number().over(W.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    found = scored(*phrase_counts(docs, group, min_count, bits)).withColumn("rank", rank.cast("long"))
    return found.where(F.col("rank") <= top).select("grp", "rank", "phrase", "a", "l", "r", "n", "score")
