"""Token counts, language profiles, templates, line chunks and the network against plain versions."""

import random
import zlib

import numpy as np
from conftest import SF01
from pyspark.sql import functions as F

from quartermart.llm import toxicity as T
from quartermart.llm.common import held_out, read
from quartermart.llm.decontaminate import Index, Templates, leaked_items
from quartermart.llm.language import label_languages
from quartermart.llm.line_dedup import dedup_lines
from quartermart.llm.wordpiece import Automaton, count_tokens, load_vocabulary


def greedy(word, start, inner):
    """Word pieces by trying the longest first."""
    n, at, pieces = 0, 0, start
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in pieces), 0)
        if not size:
            return 1
        n, at, pieces = n + 1, at + size, inner
    return n


def test_automaton_counts_greedy_pieces():
    r = random.Random(1)
    for _ in range(400):
        letters = b"abc"[: r.choice([1, 2, 3])]
        piece = lambda: bytes(r.choice(letters) for _ in range(r.randint(1, 5)))
        start, inner = {piece() for _ in range(r.randint(1, 8))}, {piece() for _ in range(r.randint(1, 8))}
        automaton = Automaton(start, inner)
        for _ in range(60):
            w = bytes(r.choice(letters) for _ in range(r.randint(1, 14)))
            assert automaton.count(w) == greedy(w, start, inner), (w, start, inner)


def test_token_counts_of_the_table(spark):
    start, inner = load_vocabulary()
    docs = read(spark, SF01, "documents").where("doc_id < 60")
    for r in count_tokens(docs, (start, inner)).collect():
        words = r.text.encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w, start, inner) if len(w) <= 200 else 1 for w in words))


def test_held_out_rows_follow_the_contract(spark):
    rows = read(spark, SF01, "documents").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_language_accuracy_on_held_out_rows(spark):
    docs = read(spark, SF01, "documents")
    rows = label_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


ITEM = "Anna buys 12 apples for 3 dollars and gives Peter 5 of the apples before she walks 2 km home to Anna again"
FILL = "some other words that nobody would ever put into a question of that kind stand here and there"


def leaks_in(spark, texts, items, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    from quartermart.llm.decontaminate import with_leaks
    return sorted((r.doc_id, r.item_id, r.verbatim) for r in with_leaks(docs, bench, **kw).select("doc_id", F.inline("leaks")).collect())


def test_templates_catch_new_numbers_names_and_units(spark):
    again = ITEM.replace("Anna", "Maria").replace("Peter", "Otto").replace("12", "97").replace("dollars", "euros").replace("3", "8.50").replace("km", "miles")
    mixed_up = again.replace("to Maria again", "to Paula again")
    shuffled = " ".join(sorted(ITEM.split()))
    texts = [f"{FILL} {ITEM} {FILL}", f"{FILL}\n{again.upper()[:0]}{again}", f"{mixed_up} {FILL}", FILL, shuffled, f"{FILL} {' '.join(ITEM.split()[:7])} {FILL}",
             ITEM.replace(" ", "  \n").replace("apples", "Apples,")]
    found = leaks_in(spark, texts, [ITEM, "12 3 5", "", FILL + " in full"])
    assert [(d, v) for d, i, v in found if i == 0] == [(0, True), (1, False), (2, False), (6, True)]
    assert {d for d, i, _ in found if i == 3} == {0, 1, 2, 3, 5}


def test_inconsistent_slots_do_not_count():
    item = "Tom met Tom near Tom when Tom saw Tom with the other people of Tom"
    index = Index([(1, item)])
    from quartermart.llm.decontaminate import find_leaks
    words = lambda text: Templates(index.common)([w.encode() for w in text.split()])
    assert find_leaks(words(item.replace("Tom", "Jim")), index)[0][4] is False
    names = iter(["Jim", "Bob", "Kim", "Lea", "Eve", "Ute"])
    assert not find_leaks(words(" ".join(next(names) if w == "Tom" else w for w in item.split())), index)


def test_slices_of_the_benchmark_change_nothing(spark):
    r = random.Random(2)
    items = [" ".join(f"w{r.randrange(50)}" for _ in range(20)) for _ in range(30)]
    texts = [f"{FILL} {items[k]} {FILL} {items[(k * 7) % 30]}" for k in range(30)]
    assert leaks_in(spark, texts, items) == leaks_in(spark, texts, items, slice_bytes=400) != []


def test_all_verbatim_items_are_found(spark):
    docs, bench = read(spark, SF01, "documents"), read(spark, SF01, "benchmark")
    flat = lambda t: " ".join(t.split())
    items = [(b.item_id, flat(b.text)) for b in bench.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in flat(d.text)}
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs, bench).collect()}
    assert want and want <= got and len(got) <= 1.1 * len(want)


def test_chunks_survive_shifts(spark):
    """A shared run of lines is found wherever it stands; what is kept is the first occurrence."""
    r = random.Random(9)
    shared = [f"shared line {i}" for i in range(40)]
    rows = []
    for d in range(12):
        own = [f"own {d} {r.random()}" for _ in range(20)]
        at = r.randint(0, 20)
        rows.append((d, "\n".join(own[:at] + shared + own[at:])))
    out = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].text == rows[0][1] and out[0].removed == []
    for d in range(1, 12):
        lines, left = rows[d][1].split("\n"), out[d].text.split("\n")
        gone = [i for x in out[d].removed for i in range(x.start, x.end)]
        assert left == [x for i, x in enumerate(lines) if i not in gone]
        assert all(lines[i] in shared for i in gone) and len(gone) >= 30
        assert all(x.end - x.start >= 2 for x in out[d].removed)


def test_gradient_is_the_slope():
    r = np.random.default_rng(0)
    net = T.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = T.Words.of([(0, [0])] + [T.word_keys(w) for w in ("alpha", "be", "Gamma,", "d", "epsilon")])
    rows = r.integers(1, 6, (4, 6))
    rows[0, 4:] = rows[1, 2:] = 0
    mask, y, weight = (rows > 0).astype(float), np.array([1, 0, 1, 0.0]), np.array([1, 2, 0.5, 1.0])

    def loss():
        logit = net.logits(net.project(net.features(words)), rows, mask)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).mean())

    g = net.gradient(words, rows, mask, y, weight)
    dense = {k: T._sum_rows(*g[k], len(net.p[k])) if k in ("word", "tri") else g[k] for k in net.p}
    for k in net.p:
        for _ in range(4):
            at = (words.word if k == "word" else words.tri)[r.integers(1, 5)] if k in ("word", "tri") else r.integers(net.p[k].shape[0])
            at = (at, *(r.integers(s) for s in net.p[k].shape[1:]))
            old = net.p[k][at]
            net.p[k][at] = old + 1e-3
            up = loss()
            net.p[k][at] = old - 1e-3
            slope = (up - loss()) / 2e-3
            net.p[k][at] = old
            assert abs(slope - dense[k][at]) < 2e-4 + 0.02 * abs(slope), k


def test_network_learns_planted_words(spark):
    """Whole texts are scored: one bad stretch far inside a long text is enough."""
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "re", "su") for b in ("ne", "ka", "vo", "ri", "do")]
    clean = lambda n: [r.choice(words) for _ in range(n)]
    bad = lambda n: [r.choice(("grumbix", "grumbal", "zork")) if r.random() < 0.15 else w for w in clean(n)]
    texts = [" ".join(bad(r.randint(20, 120)) if i % 4 == 0 else clean(r.randint(20, 120))) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = T.learn(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    long = " ".join(clean(3000) + bad(60) + clean(3000))
    more = docs.union(spark.createDataFrame([(1000, long), (1001, " ".join(clean(6000)))], docs.schema))
    rows = {x.doc_id: x for x in T.score(more, model).collect()}
    held = [x for x in rows.values() if x.doc_id < 400 and zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert np.mean([x.predicted == (x.doc_id % 4 == 0) for x in held]) > 0.95
    assert rows[1000].predicted == 1 and rows[1001].predicted == 0 and rows[1000].n_windows > 180
