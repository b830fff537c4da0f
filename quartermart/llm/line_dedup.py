"""Operator 2: line deduplication by content-defined chunks of lines.

A text's lines are hashed; a rolling hash over the hash of a line and the one
before it is lowest at some lines among their neighbours, and a chunk starts
at each such line. Boundaries depend on four lines around them only, so they
move along with the text when lines are put in or taken out before. Chunks
have at least two lines (a text of one line is one chunk, never removed).
Chunks that occur more than once in the corpus, found by digest (a first pass
counts 8 bytes of it a chunk, a bitmap of fixed size holds what occurs twice,
and a second pass writes only chunks it lets through) and then compared byte by
byte, stay at their first occurrence (smallest doc_id, then
place) and are removed elsewhere.

Chunks of lines miss most passages of a few lines only. With ``passage_words``
all repeated passages of that many words go too, wherever their lines begin
and end (``passages.py``). Both rules look at the whole texts and keep what
comes first in one order, so every text that is taken out stays somewhere.

Defined results: a null or empty text stays as it is; null ids come last; rows
that repeat both id and text are one document, and each row keeps what it
keeps; chunks without any word are never removed; the same line repeated
gives no boundary; an empty table gives an empty result; other columns pass
through, those named n_lines or removed (and passages, if asked for) are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, bitmap_of, drop_table, in_bitmap, pack, split_by, unpack, write_table
from .passages import KEY_BITS, repeated_words, without

BASE, MODULUS = 131, (1 << 31) - 1
_SPAN = 1 << 31  # a chunk is named start * _SPAN + end


def chunks_of(lines: list[str]) -> list[tuple[int, int]]:
    """Line ranges [start, end) of the chunks."""
    h = [int(hashlib.md5(x.encode("utf-8", "surrogatepass")).hexdigest()[:7], 16) for x in lines]
    roll = [0] + [(h[i] + BASE * h[i - 1]) % MODULUS for i in range(1, len(h))]
    cuts = [i for i in range(2, len(h) - 1) if roll[i] < roll[i - 1] and roll[i] < roll[i + 1]]
    return list(zip([0, *cuts], [*cuts, len(lines)], strict=True))


def _chunk_rows(texts: pa.Array) -> Iterator[tuple[int, int, bytes, str]]:
    """(row, name, digest, body) of every chunk that may be removed: two lines at least, with a word."""
    word = re.compile(WORD)
    for k in range(0, len(texts), 256):
        for row, text in enumerate(texts[k:k + 256].to_pylist(), k):
            lines = text.split("\n") if text else []
            for a, b in chunks_of(lines) if len(lines) > 1 else ():
                if b - a >= 2 and word.search(body := "\n".join(lines[a:b])):
                    yield row, a * _SPAN + b, hashlib.md5(body.encode("utf-8", "surrogatepass")).digest(), body


def _class(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often (twice at most) a class of digests occurs in a batch."""
    for b in batches:
        found, n = np.unique(np.array([_class(d) for _, _, d, _ in _chunk_rows(b.column("text"))], np.int64), return_counts=True)
        yield pa.RecordBatch.from_pydict({"key": found, "n": np.minimum(n, 2).astype(np.int8)})


def _bodies(often) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The chunks whose digests may occur twice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = often.value
        for b in batches:
            found, size = [], 0
            for c in chain(_chunk_rows(b.column("text")), [None]):
                if c and in_bitmap(bitmap, bits, np.array([_class(c[2])]))[0]:
                    found.append(c)
                    size += len(c[3])
                if found and (c is None or size > 8_000_000):
                    row, chunk, digest, body = zip(*found, strict=True)
                    own = b.select(["doc_id", "_fp"]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(chunk), pa.array(digest), pa.array(body)], ["doc_id", "_fp", "chunk", "digest", "body"])
                    found, size = [], 0

    return rows


def _without(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The text without the named chunks and the word ranges; null for a null text."""
    for texts, names, words in batches:
        out = []
        for text, chunks, ranges in zip(texts, names, words, strict=True):
            lines = [(int(c) // _SPAN, int(c) % _SPAN) for c in (() if chunks is None else chunks)]
            runs = [(int(r["start"]), int(r["end"])) for r in (() if ranges is None else ranges)]
            out.append(None if text is None else without(text, lines, runs))
        yield pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, passage_words: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated chunks taken out of ``text``; adds ``n_lines`` and ``removed`` (line ranges).

    With ``passage_words``, repeated passages of so many words are taken out
    too, and ``passages`` has their word ranges.
    """
    spark = docs.sparkSession
    keyed = pack(docs, "doc_id", "text").withColumn("_fp", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    own = keyed.select("doc_id", "_fp", "text")
    # Copies of one row are one document: they let a chunk through here, but have one place below.
    keys = own.select("text").mapInArrow(_keys, "key long, n byte").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    often = spark.sparkContext.broadcast((bitmap_of(keys, "key", KEY_BITS), KEY_BITS))
    schema = T.StructType([own.schema["doc_id"], own.schema["_fp"], *T.StructType.fromDDL("chunk long, digest binary, body string")])
    found = write_table(own.mapInArrow(_bodies(often), schema), "line-bodies")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_fp", "chunk")
    first = found.groupBy("digest", "body").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    removed = write_table(found.join(first, ["digest", "body"]).where(place != F.col("first")).groupBy(F.struct("doc_id", "_fp").alias("_doc"))
                          .agg(F.sort_array(F.collect_set("chunk")).alias("_gone")), "line-removed")
    drop_table(found)

    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    keyed = keyed.withColumns({"_doc": F.struct("doc_id", "_fp"), "n_lines": F.coalesce(lines, F.lit(0))}).drop("_fp")
    word_ranges = "array<struct<start: bigint, end: bigint>>"
    if passage_words:
        words = repeated_words(own, passage_words)
        gone, ids = removed.join(words.hint("shuffle_hash"), "_doc", "full"), removed.select("_doc").union(words.select("_doc"))
    else:
        gone, ids = removed.withColumn("_words", F.lit(None).cast(word_ranges)), removed.select("_doc")
    # Only texts that lose something (and the few that share their class) are shuffled.
    lose, same = split_by(keyed, F.xxhash64("_doc._fp"), ids.select(F.xxhash64("_doc._fp").alias("key")), KEY_BITS)
    lose = lose.join(gone.hint("shuffle_hash"), "_doc", "left")
    changed = F.col("_gone").isNotNull() | F.col("_words").isNotNull()
    left = F.pandas_udf(_without, "string").asNondeterministic()(F.when(changed, F.col("text")), F.col("_gone"), F.col("_words"))
    lose = lose.withColumn("_left", left).withColumn("text", F.when(changed, F.col("_left")).otherwise(F.col("text"))).drop("_left")
    ranges = F.transform(F.coalesce("_gone", F.array().cast("array<bigint>")), lambda c: F.struct(
        F.floor(c / F.lit(_SPAN)).cast("int").alias("start"), (c % F.lit(_SPAN)).cast("int").alias("end")))
    out = lose.unionByName(same, allowMissingColumns=True).withColumns({
        "removed": ranges, "passages": F.coalesce("_words", F.array().cast(word_ranges))})
    return unpack(out, docs.columns, ["doc_id", "text"], ["n_lines", "removed", *(["passages"] if passage_words else [])])
