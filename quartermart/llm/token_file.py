"""Operator 11: token ids of all documents as flat binary files with 64-bit document offsets.

Layout under a folder: shards ``<shard>-<try>.ids`` hold the ids of consecutive
documents as flat little-endian unsigned integers (two bytes each if the
vocabulary allows, else four) and nothing else; ``<shard>-<try>.docs`` holds for
each document its id (int64) and the offset of its first token in the whole
corpus (uint64), and after the last document the offset where the shard ends.
Both can be memory-mapped as they are. A table of shards (Parquet) names the
files that count, with their numbers of documents and tokens and their base.

Documents are dealt by range of (doc_id, hash of the text), so shards in order
hold ascending ids. A task encodes its documents, appends its ids and lengths to
files of its own name, and returns one row. Only rows that Spark commits enter
the table of shards, so files of lost or repeated attempts are never read. The
bases are prefix sums of the shards' token counts, in two levels.

The tokenizers library encodes every distinct unit of a batch once, and texts are
put together from there. A unit ends at ASCII white space, between ASCII letters
(Latin-1 letters too), digits and punctuation, and around each digit: the default
vocabulary's normaliser and splitter never reach across these borders, nor do they
tell A from a. Words with ``<|``, which may be special tokens, stay whole. A
vocabulary of which that isn't true takes ``by_word=False``: whole texts are encoded.

Defined results: a null or empty text has the end id alone; null ids come first;
rows of one id come by a hash of their texts; repeated rows each keep a place;
an empty table gives an empty folder and result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quartermart.session import ensure_checkpoint_dir

from .arrow_words import byte_classes, words_of
from .common import write_table

VOCABULARY, END_ID = "word_bpe_49k.json", 2
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Runs of a-z and the lower-case letters U+00DF to U+00FF in UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+")
#: Words kept encoded between pieces (the first so many: frequent ones come early), and the longest of them in bytes.
_MEMO, _MEMO_BYTES = 500_000, 64
_LIST = 2048
#: Shards whose counts are added up in one task.
_BLOCK = 4096


def store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path) of a folder that driver and executors share."""
    if uri.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _unit_classes() -> np.ndarray:
    """1 for ASCII letters, 2 for digits, 3 for punctuation but the apostrophe, which may start a unit with the letters after it."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 3
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[48:58] = 2
    kind[39] = 0
    return kind


def unit_cuts(raw: np.ndarray, kind: np.ndarray = _unit_classes()) -> np.ndarray:
    """Bytes of UTF-8 text at which a unit starts inside a word."""
    c = kind[raw]
    # U+00C0 to U+00FF are letters, but for the signs of multiplication and division
    latin = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
    c[latin] = c[latin + 1] = 1
    cut = np.zeros(len(raw), bool)
    cut[1:] = (c[1:] > 0) & (c[:-1] > 0) & ((c[1:] != c[:-1]) | (c[1:] == 2))
    return cut


class WordEncoder:
    """Ids of texts from those of their distinct units, encoded by the library."""

    def __init__(self, tokenizer, end_id: int, dtype: str):
        self.whole, self.end, self.dtype, self.memo = tokenizer, np.array([end_id], dtype).tobytes(), dtype, {}
        self.kind = byte_classes(SPACES)
        # lower-case Latin-1 letters pass normaliser and splitter as they are: the byte alphabet and the model will do for them
        spec = json.loads(tokenizer.to_str())
        letters = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.plain = type(tokenizer).from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": letters, "added_tokens": []}))

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as they lie in a file."""
        out = [self.memo.get(w) for w in words]
        new = [k for k, x in enumerate(out) if x is None]
        plain = [bool(PLAIN.fullmatch(words[k])) for k in new]
        for tokenizer, some in ((self.plain, [k for k, p in zip(new, plain, strict=True) if p]), (self.whole, [k for k, p in zip(new, plain, strict=True) if not p])):
            for lo in range(0, len(some), _LIST):
                part = some[lo:lo + _LIST]
                # a list of words is one input, whose tokens know their word
                found = tokenizer.encode([words[k].decode() for k in part], is_pretokenized=True, add_special_tokens=False)
                ids = np.array(found.ids, self.dtype).tobytes()
                stops = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))) * np.dtype(self.dtype).itemsize
                start = 0
                for k, stop in zip(part, stops.tolist(), strict=True):
                    out[k] = ids[start:stop]
                    start = stop
                    if len(words[k]) <= _MEMO_BYTES and len(self.memo) < _MEMO:
                        self.memo[words[k]] = out[k]
        return out

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, tokens of each document) for pieces of a column, the end id behind every document."""
        for w in words_of(texts, self.kind, lower=True, cuts_in=unit_cuts, intact=b"<|"):
            coded = w.array.dictionary_encode()
            lists = [*self.ids_of(coded.dictionary.to_pylist()), self.end]
            sizes = np.array([len(x) for x in lists]) // np.dtype(self.dtype).itemsize
            at = np.concatenate(([0], np.cumsum(sizes)))
            order = np.insert(coded.indices.to_numpy(zero_copy_only=False), w.at[1:], len(lists) - 1)
            n = sizes[order]
            stops = np.cumsum(n)
            # place of every id in the flat list of distinct words' ids
            flat = np.repeat(at[order] - (stops - n), n) + np.arange(stops[-1])
            ends = stops[w.at[1:] + np.arange(w.rows)]
            yield np.frombuffer(b"".join(lists), self.dtype)[flat], np.diff(ends, prepend=0)


class TextEncoder:
    """Ids of whole texts by the library."""

    def __init__(self, tokenizer, end_id: int, dtype: str):
        self.tokenizer, self.end, self.dtype = tokenizer, end_id, dtype

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(0, len(texts), 256):
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts[k:k + 256].to_pylist()], add_special_tokens=False)
            lists = [[*e.ids, self.end] for e in found]
            yield np.concatenate([np.array(x, self.dtype) for x in lists]), np.array([len(x) for x in lists])


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files into ``folder``; the table of shards, bases included."""
    from tokenizers import Tokenizer

    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        model = f.read()  # its size bounds what is sent out
    size = max(Tokenizer.from_buffer(model).get_vocab(with_added_tokens=True).values()) + 1
    dtype = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    # the worker processes that Spark reuses keep the encoder, with the words it knows, beside the model that made it
    spec = docs.sparkSession.sparkContext.broadcast({"model": model})
    files, root = store(folder)
    files.create_dir(root, recursive=True)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task: Spark has the other cores
        kept = spec.value
        encoder = kept.get("encoder")
        if encoder is None:
            encoder = kept["encoder"] = (WordEncoder if by_word else TextEncoder)(Tokenizer.from_buffer(kept["model"]), end_id, dtype)
        fs, path = store(folder)
        shard = TaskContext.get().partitionId()
        name = f"{shard:08d}-{uuid.uuid4().hex}"
        n_docs = n_null = n_tokens = 0
        ids_file = len_file = None
        for b in batches:
            if not b.num_rows:
                continue
            if ids_file is None:
                ids_file, len_file = fs.open_output_stream(f"{path}/{name}.ids"), fs.open_output_stream(f"{path}/{name}.lens")
            ids_column, texts, done = b.column("doc_id"), b.column("text"), 0
            for ids, lengths in encoder.encode(texts):
                ids_file.write(ids.tobytes())
                part = ids_column.slice(done, len(lengths))
                rows = np.empty((len(lengths), 2), "<i8")
                rows[:, 0], rows[:, 1] = part.fill_null(0).to_numpy(), lengths
                len_file.write(rows.tobytes())
                n_null += part.null_count
                done += len(lengths)
                n_tokens += len(ids)
            n_docs += b.num_rows
        if n_docs:
            ids_file.close()
            len_file.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "name": name, "dtype": dtype, "n_docs": n_docs, "n_null": n_null, "n_tokens": n_tokens}],
                                             pa.schema([("shard", pa.int32()), ("name", pa.string()), ("dtype", pa.string()), ("n_docs", pa.int64()),
                                                        ("n_null", pa.int64()), ("n_tokens", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
    shards = write_table(dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(
        encode, "shard int, name string, dtype string, n_docs long, n_null long, n_tokens long"), "shards")
    return _write_offsets(write_table(_bases(shards), "bases"), folder)


def _bases(shards: DataFrame) -> DataFrame:
    """``shards`` with ``base``, the tokens of all shards before: prefix sums of blocks, then inside them."""
    block = F.floor(F.col("shard") / _BLOCK)
    blocks = shards.groupBy(block.alias("block")).agg(F.sum("n_tokens").alias("n"))
    before = blocks.select("block", (F.sum("n").over(W.orderBy("block")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(W.partitionBy("block").orderBy("shard")) - F.col("n_tokens")
    return shards.withColumn("block", block).join(before, "block").withColumn("base", F.col("before") + inside).drop("block", "before")


def _write_offsets(shards: DataFrame, folder: str) -> DataFrame:
    """Turn every shard's lengths into offsets in the whole corpus; the shards as they came."""

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        for b in batches:
            for s in b.to_pylist():
                with fs.open_input_file(f"{path}/{s['name']}.lens") as f:
                    rows = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
                out = np.empty(2 * len(rows) + 1, "<u8")
                out[:-1:2] = rows[:, 0].view("<u8")
                out[1::2] = s["base"] + np.cumsum(rows[:, 1]) - rows[:, 1]
                out[-1] = s["base"] + s["n_tokens"]
                # a repeated attempt writes the same bytes; the move shows whole files only under the final name
                own = f"{path}/{s['name']}.{uuid.uuid4().hex}"
                with fs.open_output_stream(own) as f:
                    f.write(out.tobytes())
                fs.move(own, f"{path}/{s['name']}.docs")
            yield b

    return write_table(_a_task_each(shards).mapInArrow(rebase, shards.schema), "offsets")


def _a_task_each(shards: DataFrame) -> DataFrame:
    """One row a task: a row stands for a whole shard, which the planner can't see."""
    return shards.repartitionByRange(max(1, shards.count()), "shard")


def mapped(fs: pyarrow.fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the store is a file system, read else."""
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_tokens(shards: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """The documents in the files of ``shards``: doc_id, start, n_tokens and the ids, or their CRC-32 as ``<u4``."""
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int64()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        for b in batches:
            for s in b.to_pylist():
                docs, ids = mapped(fs, f"{path}/{s['name']}.docs", "<u8"), mapped(fs, f"{path}/{s['name']}.ids", s["dtype"])
                starts = np.append(docs[1::2], docs[-1]).astype(np.int64)
                for k in range(0, s["n_docs"], 4096):
                    at = starts[k:k + 4097]
                    local = (at - s["base"]).tolist()
                    spans = [ids[i:j] for i, j in zip(local, local[1:], strict=False)]
                    value = [zlib.crc32(x.astype("<u4").tobytes()) for x in spans] if digest else [x.tolist() for x in spans]
                    null = np.arange(k, k + len(spans)) < s["n_null"]
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(docs[2 * k:2 * (k + len(spans)):2]).view(np.int64), mask=null),
                                                      pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(value, last[1])], schema=schema)

    return _a_task_each(shards).mapInArrow(read, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids array<long>'}")


def new_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"


def round_trip(docs: DataFrame) -> DataFrame:
    """Write ``docs`` into a new folder of the shared checkpoint folder and read digests back from the files."""
    folder = new_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, folder), folder, digest=True)
