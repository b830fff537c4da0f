"""The Jaccard join and connected components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
from conftest import SF001

from quartermart.llm import jaccard as J
from quartermart.llm.common import read
from quartermart.llm.components import connected_components
from quartermart.llm.shingles import Hasher, word_hashes


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= 75 * (len(a) + len(sets[j]) - o):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(tuple(r) for r in J.near_groups(df).collect())


def edited(r, words, share):
    return [f"e{r.randrange(10**6)}" if r.random() < share else w for w in words]


def test_families_of_near_copies(spark, monkeypatch):
    """Families at many distances around the threshold, sharing passages; few words make tokens frequent."""
    monkeypatch.setattr(J, "FREQUENT", 6)
    monkeypatch.setattr(J, "LOCAL", 2)
    r = random.Random(11)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for f in range(6):
        base = [f"f{f}w{r.randrange(300)}" for _ in range(r.choice([12, 60, 150]))]
        for k in range(r.choice([3, 30, 60])):
            w = edited(r, base, r.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1]))
            cut = r.choice([0, 0, 3, 8, 20])
            rows.append((len(rows), " ".join((passage if r.random() < 0.3 else []) + w[cut // 2: len(w) - cut // 2])))
    rows += [(len(rows), "A b C"), (len(rows) + 1, "a B c"), (len(rows) + 2, "a b c d e"), (len(rows) + 3, ""), (len(rows) + 4, "a b c d e f")]
    assert got(spark, rows) == brute(rows)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF001, "documents").collect()]
    assert sorted(tuple(r) for r in J.near_groups(read(spark, SF001, "documents")).collect()) == brute(rows)


def test_keys_find_every_pair():
    """Sets at the threshold share a key, whichever tokens are frequent."""
    r = np.random.default_rng(2)
    for trial in range(300):
        n = int(r.integers(3, 80))
        pool = r.integers(0, 1 << 63, 3 * n, dtype=np.uint64) << np.uint64(1)
        frequent = np.zeros(1 << (J.CLASS_BITS - 3), np.uint8)
        for t in pool[r.random(3 * n) < r.choice([0, 0.3, 0.8, 1])]:
            c = int(t >> np.uint64(64 - J.CLASS_BITS))
            frequent[c >> 3] |= np.uint8(1 << (c & 7))
        x = np.unique(r.choice(pool, n, replace=False))
        drop, add = int(r.integers(0, n // 4 + 1)), int(r.integers(0, n // 4 + 1))
        y = np.unique(np.concatenate((r.permutation(x)[drop:], r.choice(pool, add, replace=False))))
        o = len(np.intersect1d(x, y))
        if len(y) < 3 or len(x) < 3 or o == len(x) == len(y) or 100 * o < 75 * (len(x) + len(y) - o):
            continue
        kx, ky = J._keys(x, frequent)[0], J._keys(y, frequent)[0]
        assert len(np.intersect1d(kx, ky)), (trial, n)


def test_hashes_do_not_depend_on_batches():
    texts = ["Ab cd\tef", None, "", "x" * 5000 + " y z", "ab CD ef gh ij kl " * 400]
    hasher = Hasher()
    whole = [w.tolist() for _, w in word_hashes(pa.array(texts), hasher)]
    assert [len(w) for w in whole] == [3, 0, 0, 3, 2400]
    import quartermart.llm.shingles as S
    old, S._PIECE = S._PIECE, 64
    try:
        assert [w.tolist() for _, w in word_hashes(pa.chunked_array([["skip"] + texts]).chunk(0).slice(1), Hasher())] == whole
    finally:
        S._PIECE = old


def test_components_equal_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3), (2000, 2001), (2000, 2001)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == {x: find(x) for x in list(root)}
