"""Sainte-Lague quotas and targets against brute force."""

import heapq
import random

from pyspark.sql import functions as F

from quartermart.llm.mixing import mix, sainte_lague, source_targets


def brute_seats(votes, caps, seats):
    won = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0 and caps[i] > 0]
    heapq.heapify(heap)
    while seats and heap:
        _, i = heapq.heappop(heap)
        won[i] += 1
        seats -= 1
        if won[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def test_sainte_lague_equals_highest_quotients(spark):
    r = random.Random(3)
    rows, want = [], {}
    for g in range(60):
        n = r.randint(1, 12)
        votes = [float(r.choice([0, 1, 7, r.randint(1, 5000)])) for _ in range(n)]
        seats = r.randint(0, 60)
        caps = [seats + 1] * n
        won = brute_seats(votes, caps, seats)
        for i in range(n):
            rows.append((g, i, votes[i], caps[i], seats if sum(votes) else 0))
            want[g, i] = won[i] if sum(votes) else 0
    df = spark.createDataFrame(rows, "g int, k int, _votes double, _cap long, _seats long")
    assert {(r["g"], r["k"]): r["_quota"] for r in sainte_lague(df, ["g"], "k").collect()} == want


def test_targets_stop_at_three_times_the_size(spark):
    sizes = {"aa": 1000, "ab": 10, "ac": 50, "ad": 400, None: 5}
    weights = [1, 2, 3]
    total, names = sum(sizes.values()), ["aa", "ab", "ac", "ad", None]
    capped, target = set(), {}
    while True:  # as the contract words it
        free = [i for i in range(5) if i not in capped]
        rest = total - sum(3 * sizes[names[i]] for i in capped)
        target = {i: 3 * sizes[names[i]] if i in capped else rest * weights[i % 3] / sum(weights[j % 3] for j in free) for i in range(5)}
        over = {i for i in free if target[i] > 3 * sizes[names[i]]}
        if not over:
            break
        capped |= over
    df = spark.createDataFrame([("n" if s is None else "a" + s, n) for s, n in sizes.items()], "_src string, size long")
    got = {r["_src"]: r["target"] for r in source_targets(df).collect()}
    assert all(abs(got["n" if s is None else "a" + s] - target[i]) < 1e-9 for i, s in enumerate(names))


def test_mix_comes_near_and_is_repeatable(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" * 3 for _ in range(r.randint(0, 300))), r.choice(["hot"] * 5 + ["b", "c", "d", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(df, shard_tokens=5000)
    a = {r.doc_id: (r["taken"], r["target"], r["source"]) for r in out.collect()}
    b = {r.doc_id: (r["taken"], r["target"], r["source"]) for r in mix(df.repartition(7), shard_tokens=5000).collect()}
    assert a == b
    for s in {x[2] for x in a.values()}:
        own = [x for x in a.values() if x[2] == s]
        assert abs(sum(x[0] for x in own) - own[0][1]) <= 32
    pieces = out.select("taken", "size", "passes", F.expr("aggregate(pieces, 0L, (s, p) -> s + p.end - p.start)").alias("more")).collect()
    assert all(r["taken"] == r["passes"] * r["size"] + r["more"] <= 3 * r["size"] for r in pieces)
