"""Token files against the library on whole texts, and against their own layout."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001
from tokenizers import Tokenizer

from quartermart.llm import queries as Q
from quartermart.llm import token_file as T

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(T.VOCABULARY))


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, T.END_ID]


def want(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = whole(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library_on_whole_texts(spark, tokenizer):
    docs = sorted(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(map(tuple, Q.op11_token_file(spark, SF001).collect())) == want(tokenizer, docs)


@pytest.mark.parametrize("by_word", [True, False])
def test_odd_rows(spark, odd, tokenizer, by_word, tmp_path):
    shards = T.write_tokens(odd, str(tmp_path), by_word=by_word)
    got = sorted(map(tuple, T.read_tokens(shards, str(tmp_path)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r.doc_id for r in odd.collect()), key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    ids = lambda rows: sorted((i, w) for i, w in rows)
    assert ids((str(r[0]), r[3]) for r in got) == ids((str(r.doc_id), whole(tokenizer, r.text)) for r in odd.collect())


def test_large_ids_null_ids_and_one_id_held_by_a_third(spark, tokenizer, tmp_path):
    rows = [(2**60 + 1, "a b"), (None, "x"), (2**60 + 3, "c"), (-5, "minus")] + [(7, f"copy {i % 3}") for i in range(40)]
    shards = T.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(6), str(tmp_path))
    got = [tuple(r) for r in T.read_tokens(shards, str(tmp_path), digest=True).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, -5, *[7] * 40, 2**60 + 1, 2**60 + 3]
    by_text = sorted(zlib.crc32(np.array(whole(tokenizer, t), "<u4").tobytes()) for _, t in rows)
    assert sorted(r[3] for r in got) == by_text


def test_files_are_flat_and_mapped_in_place(spark, tokenizer, tmp_path):
    rows = [(i, f"word {i} " * (i % 7)) for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = T.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path)).orderBy("shard").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    flat, offsets = [], []
    for s in shards:
        ids, docs = np.memmap(tmp_path / f"{s.name}.ids", "<u2", "r"), np.memmap(tmp_path / f"{s.name}.docs", "<u8", "r")
        assert len(ids) == s.n_tokens and len(docs) == 2 * s.n_docs + 1 and s.base == len(flat) and docs[-1] == s.base + len(ids)
        flat += ids.tolist()
        offsets += docs[1::2].tolist()
    assert len(shards) > 1 and flat == [x for _, t in rows for x in whole(tokenizer, t)]
    assert all(flat[o - 1] == T.END_ID for o in offsets[1:])


def test_words_are_put_together_as_the_library_splits_whole_texts(tokenizer):
    import pyarrow as pa

    rng = random.Random(3)
    parts = ["don't", "I'LL", " ", "\t\n", " ", "　", "é", "́", "Ωμέγας", "ΣΑΣ", "İ", "ﬁ", "12345", "x9", "<|endoftext|>", "<|start", "日本語", "😀!", "--", "'s", "\x00", "\x1f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)] + [None, "", "x" * 5000]
    encoder = T.WordEncoder(tokenizer, T.END_ID, "<u2")
    flat = [(ids.tolist(), lengths.tolist()) for ids, lengths in encoder.encode(pa.array(texts))]
    assert [i for ids, _ in flat for i in ids] == [i for t in texts for i in whole(tokenizer, t)]
    assert [n for _, ns in flat for n in ns] == [len(whole(tokenizer, t)) for t in texts]


def test_bases_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "_BLOCK", 4)
    shards = spark.createDataFrame([(i, i * i + 1) for i in range(0, 30, 2)], "shard int, n_tokens long")
    got = T._bases(shards).orderBy("shard").collect()
    assert [r.base for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_no_documents(spark, none, tmp_path):
    assert T.read_tokens(T.write_tokens(none, str(tmp_path)), str(tmp_path)).collect() == []


def test_wide_ids_take_four_bytes(spark, tokenizer, tmp_path):
    shards = T.write_tokens(spark.createDataFrame([(1, "a")], SCHEMA), str(tmp_path), end_id=70_000)
    assert T.read_tokens(shards, str(tmp_path)).first().ids == [*whole(tokenizer, "a")[:-1], 70_000]
    assert shards.first().dtype == "<u4"
