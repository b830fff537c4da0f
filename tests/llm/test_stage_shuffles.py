"""Which texts the pipeline's stages shuffle."""

import random

from quartermart.llm import stages


def texts(n=60, words=80):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(words))) for i in range(n)]
    return rows + [(n + i, t if i % 3 else t + " more") for i, (_, t) in enumerate(rows[:9])]


def test_texts_alone_in_their_group_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in [*texts(), (100, None), (101, " ")]], "doc_id long, text string, lang string, source string, n_chars long")
    repeated = docs.union(docs.where("doc_id in (3, 61)"))
    kept = stages.keep_one_of_group(spark, repeated, "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(60), 100, 101] and kept.columns == docs.columns
    node = kept._jdf.queryExecution().sparkPlan()
    while node.nodeName() != "Union":
        node = node.children().head()
    some, alone = node.children().head().toString(), node.children().last().toString()
    assert "Join" in some and "Join" not in alone and "Aggregate" not in alone
