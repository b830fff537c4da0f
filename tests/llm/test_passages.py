"""Repeated passages in a few lines, against a search of all windows."""

import random

from quartermart.llm import stages
from quartermart.llm.line_dedup import chunks_of, dedup_lines
from quartermart.llm.passages import without


def brute_texts(rows, n):
    """Texts without what an earlier window of ``n`` words or an earlier chunk has, by dictionaries of all of them."""
    seen, chunks, out = set(), set(), {}
    for d, text in sorted(rows):
        words, lines, gone, cut = text.split(), text.split("\n"), [], []
        for p in range(len(words) - n + 1):
            window = tuple(words[p:p + n])
            if window in seen:
                gone.append((p, p + n))
            seen.add(window)
        for a, b in chunks_of(lines):
            body = "\n".join(lines[a:b])
            if b - a >= 2 and body.split():
                if body in chunks:
                    cut.append((a, b))
                chunks.add(body)
        out[d] = without(text, cut, gone)
    return out


def test_passages_of_one_to_five_lines(spark):
    """Passages of 50 to 80 words in 1 to 5 lines, at any place of a text, some cut short or set in other lines."""
    r = random.Random(4)
    own = iter(range(10**6))
    fresh = lambda n: [f"w{next(own)}" for _ in range(n)]
    passages = [(fresh(r.randint(50, 80)), k % 5 + 1) for k in range(25)]

    def set_in(words, lines):
        cuts = sorted(r.sample(range(1, len(words)), lines - 1))
        return "\n".join(" ".join(words[a:b]) for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True))

    rows = []
    for d in range(75):
        words, lines = passages[d % 25]
        body = set_in(words if d % 7 else words[3:45], lines)
        parts = [" ".join(fresh(r.randint(1, 40))) for _ in range(r.randint(0, 3))]
        parts.insert(r.randint(0, len(parts)), body)
        rows.append((d, r.choice(["\n", " "]).join(parts)))
    rows += [(75, "a b c d e f " * 40), (76, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {x.doc_id: x for x in dedup_lines(df, 50).collect()}
    assert {d: x.text for d, x in out.items()} == brute_texts(rows, 50)
    for d in range(25, 75):
        if d % 7 and (d - 25) % 7 and (d < 50 or (d - 50) % 7):
            assert not set(passages[d % 25][0]) & set(out[d].text.split()), d
    assert all(out[d].passages == [] for d in range(25))
    kept = {x.doc_id: x.text for x in stages.drop_repeated_lines(spark, df.selectExpr("*", "length(text) AS n_chars"), None).collect()}
    assert kept == {d: t for d, t in brute_texts(rows, 50).items() if t.split()} and 76 not in kept


def test_random_texts_of_few_words_equal_the_search(spark):
    r = random.Random(8)
    rows = [(d, "".join(r.choice("ab") + r.choice("  \n") for _ in range(r.randint(0, 60)))) for d in range(80)]
    for n in (4, 7, 12):
        got = {x.doc_id: x.text for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), n).collect()}
        assert got == brute_texts(rows, n)


def test_windows_that_repeat_inside_one_segment(spark):
    """Texts of one period, so short that all windows share one key."""
    rows = [(d, " ".join(f"p{d}q{k % period}" for k in range(length))) for d, (period, length) in enumerate([(1, 13), (2, 14), (3, 15), (5, 17), (7, 40), (1, 90)])]
    got = {x.doc_id: x.text for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 12).collect()}
    assert got == brute_texts(rows, 12) and got[0] != rows[0][1]


def test_a_bitmap_without_room_changes_nothing(spark, monkeypatch):
    from quartermart.llm import passages

    monkeypatch.setattr(passages, "KEY_BITS", 16)
    r = random.Random(2)
    rows = [(d, "".join(r.choice("abc") + r.choice("  \n") for _ in range(r.randint(0, 60)))) for d in range(60)]
    got = {x.doc_id: x.text for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()}
    assert got == brute_texts(rows, 7)
