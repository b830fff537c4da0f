"""Rows of one id and size: which text is taken must not depend on where the rows lie."""

from quartermart.llm.mixing import mix


def test_rows_of_one_id_and_size_are_taken_by_text(spark):
    rows = [(None, " ".join(f"t{i}" for _ in range(40)), "abc"[i % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [{r.text: (r.passes, r.pieces) for r in mix(x).collect()} for x in (df.coalesce(1), df.orderBy("text").coalesce(1), df.orderBy(df.text.desc()).coalesce(1))]
    assert taken[0] == taken[1] == taken[2]
