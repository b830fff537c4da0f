"""Words above the usual cap of 200 bytes: text without spaces, long encoded strings."""

from quartermart.llm.queries import op3_token_counts
from quartermart.llm.wordpiece import count_tokens, load_vocabulary

from .test_text_operators import greedy

TEXTS = ["這是一個沒有空格的很長的句子" * 20, "ดี" * 150 + " and " + "日本語" * 100, "QUJD" * 300, "short words only", "x" * 201]


def test_the_query_counts_every_word_in_full(spark, tmp_path):
    start, inner = load_vocabulary()
    path = str(tmp_path)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{path}/documents.parquet")
    want = {i: sum(greedy(w, start, inner) for w in t.encode().split()) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in op3_token_counts(spark, path).collect()} == want
    assert want[0] > 100 and want[2] > 100
    capped = {r.doc_id: r.n_tokens for r in count_tokens(docs).collect()}
    assert (capped[0], capped[1], capped[3]) == (1, 3, want[3])
