"""Operator 9: n-gram Jaccard join by token-combination prefixes.

A text's set holds the hashes of its distinct five-word shingles. Texts with
equal sets collapse to one node first. Tokens (shingles) are ordered rare
before frequent, by hash within; a token is frequent if its hash class has
many entries, a bounded bitmap that every task applies alike. With n tokens and
similarity t = 3/4, two linked sets share a token among the first n - ceil(t n) + 1
of each. If the first shared token is rare, both index it alone. If it is
frequent, all shared tokens are, and the prefix is extended to n // 2 + 2: among
so many some two shared tokens are neighbours in both orders (mismatches can't
separate all), so indexing the combinations of neighbouring frequent tokens
finds every such pair with a number of entries linear in n.

Most keys are held by one set only. A pass over the texts counts the keys alone
(about three bytes each: sorted lists of a task, dealt out by ranges of their
hashes), a bitmap of fixed size holds those that two sets have, and only entries
it lets through are written. Of rows with equal sets one is indexed, told by
another bitmap. When the bitmaps fill up, more entries are written; the result
is the same.

Entries that meet need not be paired with each other in full. An entry stands
at position i of a set of n (for a combination, i is the number of rare
tokens): if it is the first that two sets share, they share no more than what
both have left from there, and a pair with too little left is dropped. By
falling n - 7 i, the slack, each entry is paired with the first of its key and
the ``NEIGHBOURS`` before it; that is every pair of a small key. So the rare
tokens that two sets share in their prefixes are known but for those of larger
keys, of which there are at most as many as the set with fewer has. A pair is
dropped, too, if those and what is left after the prefix, or after the last
shared token, are too few. The rest is verified on the whole sets, and links form components; keys with
more entries are then searched for pairs that the slack allows and that join
different components. So no link between different components is lost, and a
group of very many copies costs about one verification an entry.

Defined results: a null, empty or blank text has no shingle and is linked with
nothing; a text of fewer than five words has one, the whole sequence; rows
repeating a text are linked; a null doc_id takes part, and its component is
the smallest id it reaches (null if none); an empty table gives an empty result;
other columns are ignored. Sets count as equal if their 64-bit hashes (of size
and tokens) are; the two sets of a pair are compared by 40 bits a token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quartermart.session import shuffles_dropped

from .common import bitmap_of, drop_table, in_bitmap, write_table
from .components import connected_components
from .shingles import Hasher, mix, word_hashes

#: The similarity is NUMERATOR / 100 at least.
NUMERATOR = 75
#: Hash classes of tokens; a class with FREQUENT entries is frequent. A task reports classes with LOCAL entries.
CLASS_BITS, FREQUENT, LOCAL = 22, 32, 6
NEIGHBOURS = 4
_SEEN = 1_000_000  # sets a task remembers, so that its copies of one set are indexed once
_NODES = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("class", pa.int32()), ("entries", pa.int64())])
_ENTRIES = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("slack", pa.int32()), ("singles", pa.int32())])
_SETS = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary())])
#: Classes of rows that stand for a set and of keys that two sets have, as powers of two: 8 MB each.
ROW_BITS, KEY_BITS = 26, 26
#: Hashes of keys are dealt out in 2 ** RANGE_BITS ranges, as lists of 32 bits each; a task makes lists of so many keys.
RANGE_BITS, _KEYS = 10, 1 << 20
#: Words of 64 bits in the bitmap of nodes whose sets are needed.
NODE_WORDS = 1 << 19


def _sets(batch: pa.RecordBatch, hasher: Hasher) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, sorted set of tokens, node) for every row of column ``text``."""
    for row, words in word_hashes(batch.column("text"), hasher):
        tokens = np.unique(hasher.shingles(words))
        total = mix(tokens ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(tokens))
        yield row, tokens, int(mix(np.array([total], np.uint64)).view(np.int64)[0])


class _Once:
    """Whether a node comes up for the first time in this task (as far as it remembers)."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, node: int) -> bool:
        if node in self.seen:
            return False
        if len(self.seen) >= _SEEN:
            self.seen.clear()
        self.seen.add(node)
        return True


def _indexed(batches: Iterator[pa.RecordBatch], firsts) -> Iterator[pa.RecordBatch]:
    """The texts of the rows that stand for their sets (a few others may come along)."""
    bitmap = firsts.value
    for b in batches:
        yield b.filter(pa.array(in_bitmap(bitmap, ROW_BITS, b.column("row").to_numpy())))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, once, classes = Hasher(), _Once(), np.zeros(1 << CLASS_BITS, np.int32)
    for b in batches:
        n, node = np.zeros(len(b), np.int32), np.zeros(len(b), np.int64)
        for row, tokens, own in _sets(b, hasher):
            n[row], node[row] = len(tokens), own
            if len(tokens) and once(own):
                np.add.at(classes, (tokens >> np.uint64(64 - CLASS_BITS)).astype(np.int64), 1)
        none = pa.nulls(len(b), pa.int32()), pa.nulls(len(b), pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("print"), pa.array(n), pa.array(node), *none], schema=_NODES)
    usual = classes.mean()  # what falls into any class of a large task by chance
    many = np.flatnonzero(classes >= max(LOCAL, usual + 5 * np.sqrt(usual)))
    none = [pa.nulls(len(many), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
    yield pa.RecordBatch.from_arrays([*none, pa.array(many.astype(np.int32)), pa.array(classes[many].astype(np.int64) - int(usual))], schema=_NODES)


def _keys(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, slacks, number of single tokens) under which a set of at least three tokens is indexed."""
    n = len(tokens)
    of_class = (tokens >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
    often = (frequent[of_class >> 3] >> (of_class & 7).astype(np.uint8)) & 1 == 1
    rare = tokens[~often]
    prefix = n - -(-NUMERATOR * n // 100) + 1
    short, one = np.uint64(16), np.uint64(1)  # keys have 48 bits, the last of which marks combinations
    singles = min(len(rare), prefix)
    keys, at = rare[:prefix] >> short & ~one, np.arange(singles)
    if len(rare) < prefix:
        f = tokens[often][: max(0, n // 2 + 2 - len(rare))]
        with np.errstate(over="ignore"):
            pairs = mix(f[:-1] * np.uint64(3) + f[1:]) >> short | one
        keys, at = np.concatenate((keys, pairs)), np.concatenate((at, np.full(len(pairs), len(rare))))
    return keys, n - 7 * at, singles


def _lists(keys: np.ndarray) -> pa.RecordBatch:
    """(range, list) of the hashes of ``keys``: steps from one to the next, first their lowest bytes, those of the highest last."""
    h = np.sort(mix(keys) >> np.uint64(32 - RANGE_BITS))
    h = h[np.concatenate((np.ones(min(2, len(h)), bool), h[2:] != h[:-2]))]  # twice at most
    cuts = np.searchsorted(h >> np.uint64(32), np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64))
    low = h.astype(np.uint32)
    step = np.diff(low, prepend=np.uint32(0))
    at = np.flatnonzero(np.diff(cuts))
    step[cuts[at]] = low[cuts[at]]
    lists = [step[cuts[r]:cuts[r + 1]].view(np.uint8).reshape(-1, 4).T.tobytes() for r in at]
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(lists, pa.binary())], ["at", "list"])


def _key_lists(frequent, firsts):
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, once, bitmap = Hasher(), _Once(), frequent.value
        out, held = [], 0
        for b in _indexed(batches, firsts):
            for _, tokens, node in _sets(b, hasher):
                if len(tokens) >= 3 and once(node):
                    out.append(_keys(tokens, bitmap)[0])
                    held += len(out[-1])
                    if held > _KEYS:
                        yield _lists(np.concatenate(out))
                        out, held = [], 0
        if out:
            yield _lists(np.concatenate(out))

    return lists


def _twice(lists: pa.Table) -> pa.Table:
    """The part of the bitmap that a range has: a bit for the class of every hash that occurs twice."""
    found = []
    for steps in lists.column("list").to_pylist():
        found.append(np.cumsum(np.ascontiguousarray(np.frombuffer(steps, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32))
    h = np.sort(np.concatenate(found))
    bits = np.zeros(1 << (KEY_BITS - RANGE_BITS), bool)
    bits[h[1:][h[1:] == h[:-1]] >> np.uint32(32 + RANGE_BITS - KEY_BITS)] = True
    return pa.table({"block": lists.column("at").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _shared_keys(texts: DataFrame, frequent, firsts):
    """The bitmap of hashes of keys that two sets have (and of a few others), sent to all tasks."""
    with shuffles_dropped(texts.sparkSession):
        blocks = (texts.mapInArrow(_key_lists(frequent, firsts), "at int, list binary")
                  .groupBy("at").applyInArrow(_twice, "block int, bits binary").collect())
    bitmap = np.zeros((1 << RANGE_BITS, 1 << (KEY_BITS - RANGE_BITS - 3)), np.uint8)
    for r in blocks:
        bitmap[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return texts.sparkSession.sparkContext.broadcast(bitmap.ravel())


def _entries(frequent, firsts, shared):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, once, bitmap, some = Hasher(), _Once(), frequent.value, shared.value
        out, held = [], 0

        def flush() -> pa.RecordBatch:
            n = np.array([len(k) for k, *_ in out])
            each = lambda i, kind: pa.array(np.repeat(np.array([x[i] for x in out], kind), n))
            keys, slack = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), each(2, np.int64), each(3, np.int32), pa.array(slack.astype(np.int32)),
                                               each(4, np.int32)], schema=_ENTRIES)

        for b in _indexed(batches, firsts):
            for _, tokens, node in _sets(b, hasher):
                if len(tokens) >= 3 and once(node):  # smaller sets are linked by being equal only
                    keys, slack, singles = _keys(tokens, bitmap)
                    meet = in_bitmap(some, KEY_BITS, mix(keys))
                    out.append((keys[meet], slack[meet], node, len(tokens), singles))
                    held += len(out[-1][0])
                    if held > 200_000:
                        yield flush()
                        out, held = [], 0
        if out:
            yield flush()

    return entries


def _token_sets(needed, firsts):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, once, bitmap = Hasher(), _Once(), needed.value
        for b in _indexed(batches, firsts):
            rows = [(node, len(tokens), _packed(tokens)) for _, tokens, node in _sets(b, hasher)
                    if int(bitmap[node >> 6 & NODE_WORDS - 1]) >> (node & 63) & 1 and once(node)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SETS.types, strict=True)] if rows
                                             else [pa.array([], t) for t in _SETS.types], schema=_SETS)

    return sets


def _packed(tokens: np.ndarray) -> bytes:
    """The upper 40 bits of each token: first 32 bits of all, then 8 bits of all."""
    high = np.unique(tokens >> np.uint64(24))
    return (high >> np.uint64(8)).astype(np.uint32).tobytes() + (high & np.uint64(255)).astype(np.uint8).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) << np.uint64(8) | np.frombuffer(data, np.uint8, n, 4 * n)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y, n, m in zip(*(b.column(c).to_pylist() for c in ("x", "y", "n", "m")), strict=True):
            both = np.concatenate((_unpacked(x), _unpacked(y)))
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= NUMERATOR * (n + m - shared))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _size_fits(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * NUMERATOR


def _enough(shared: Column, n: Column, m: Column) -> Column:
    """Whether two sets of ``n`` and ``m`` that share no more than ``shared`` can be linked."""
    return shared * (100 + NUMERATOR) >= (n + m) * NUMERATOR


def _verify(pairs: DataFrame, texts: DataFrame, firsts) -> DataFrame:
    """The pairs (a, b) that are links.

    Sets are made anew from the texts, only for nodes that a bounded bitmap
    lets pass, and dealt out by node once for both ends.
    """
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    with shuffles_dropped(pairs.sparkSession):
        words = needed.groupBy(F.expr(f"(node >> 6) & {NODE_WORDS - 1}").alias("at")).agg(F.expr("bit_or(shiftleft(1L, int(node & 63)))").alias("bits")).toPandas()
    bitmap = np.zeros(NODE_WORDS, np.int64)
    bitmap[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    needed = texts.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))
    sets = (texts.mapInArrow(_token_sets(needed, firsts), "node long, n int, tokens binary")
            .repartition("node").dropDuplicates(["node"]))
    side = lambda node, n, tokens: sets.select(F.col("node").alias(node), F.col("n").alias(n), F.col("tokens").alias(tokens))
    both = pairs.select("a", "b").join(side("b", "m", "y"), "b").join(side("a", "n", "x"), "a")
    return write_table(both.select("a", "b", "x", "y", "n", "m").mapInArrow(_linked, "a long, b long"), "jaccard-links")


def _frequent_classes(found: DataFrame):
    """The bitmap of frequent classes, 2 ** CLASS_BITS bits at any size of the corpus, sent to all tasks."""
    often = found.where("class is not null").groupBy("class").agg(F.sum("entries").alias("n")).where(F.col("n") >= FREQUENT)
    with shuffles_dropped(found.sparkSession):
        bits = often.groupBy(F.expr("class div 8").alias("at")).agg(F.expr("bit_or(shiftleft(1, class % 8))").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (CLASS_BITS - 3), np.uint8)
    bitmap[bits["at"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64).astype(np.uint8)
    return found.sparkSession.sparkContext.broadcast(bitmap)


def _first_rows(rows: DataFrame):
    """The bitmap of rows that stand for their sets, one a set, sent to all tasks."""
    first = rows.where("n > 0").groupBy("node").agg(F.min(F.xxhash64("doc_id", "print")).alias("row"))
    return rows.sparkSession.sparkContext.broadcast(bitmap_of(first, "row", ROW_BITS))


def near_groups(docs: DataFrame, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``with_groups`` adds ``print`` (xxhash64 of the text) and ``group``, a name
    of the component that is there even if none of its rows has an id (null: no shingle).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("print"))
    found = write_table(texts
                        .mapInArrow(_nodes, "doc_id long, print long, n int, node long, class int, entries long"), "jaccard-nodes")
    frequent = _frequent_classes(found)
    rows = found.where("class is null").select("doc_id", "print", "n", "node")
    firsts = _first_rows(rows)
    texts = texts.select("text", F.xxhash64("doc_id", "print").alias("row"))
    shared = _shared_keys(texts, frequent, firsts)

    # Entries that share a key, each with those it is paired with.
    order = W.partitionBy("key").orderBy(F.col("slack").desc(), "node")
    one = F.struct("node", "n", "slack", "singles")
    entries = (texts.mapInArrow(_entries(frequent, firsts, shared), "key long, node long, n int, slack int, singles int")
               .repartition("key").dropDuplicates(["key", "node"]))
    met = entries.withColumns({"m": F.count("*").over(W.partitionBy("key")), "first": F.first(one).over(order),
                               **{f"before{i}": F.lag(one, i).over(order) for i in range(1, NEIGHBOURS + 1)}}).where("m > 1")
    near = F.array_distinct(F.array("first", *(f"before{i}" for i in range(1, NEIGHBOURS + 1))))
    left = lambda n, slack: n - ((n - slack) / 7).cast("int")
    meets = lambda n, slack, m, other: _size_fits(n, m) & _enough(F.least(left(n, slack), left(m, other)), n, m)
    near = F.filter(near, lambda p: p.isNotNull() & (p["node"] != F.col("node")) & _size_fits(p["n"], F.col("n")))
    large = F.col("m") > NEIGHBOURS + 2
    met = write_table(met.select("key", "node", "n", "slack", "singles", large.alias("large"), F.col("first.slack").alias("top"), near.alias("near"))
                      .where((F.size("near") > 0) | F.col("large")), "jaccard-met")

    # Candidate pairs a < b with the positions of the last shared token in both.
    single = F.col("key") % 2 == 0
    at = lambda n, slack: F.when(single, ((n - slack) / 7).cast("int"))
    end = lambda of: F.struct(*(F.col(of + c).alias(c) for c in ("node", "n", "singles")),
                              at(F.col(of + "n"), F.col(of + "slack")).alias("at"))
    ends = met.select("node", "key", "n", "slack", "singles", "large", F.explode("near").alias("o"))
    ends = ends.select(end("").alias("x"), end("o.").alias("y"), (single & ~F.col("large")).cast("int").alias("seen"),
                       meets(*map(F.col, ("n", "slack", "o.n", "o.slack"))).alias("first"))
    lower = F.col("x.node") < F.col("y.node")
    ends = ends.select(F.when(lower, F.col("x")).otherwise(F.col("y")).alias("x"), F.when(lower, F.col("y")).otherwise(F.col("x")).alias("y"), "seen", "first")
    pairs = ends.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.max("x.n").alias("n"), F.max("y.n").alias("m"), F.sum("seen").alias("seen"), F.bool_or("first").alias("first"),
        F.max(F.when(F.col("first"), F.col("x.at"))).alias("i"), F.max(F.when(F.col("first"), F.col("y.at"))).alias("j"),
        F.max(F.col("x.n") - F.col("x.singles")).alias("after_a"), F.max(F.col("y.n") - F.col("y.singles")).alias("after_b"))
    hidden = write_table(met.where(F.col("large") & single).groupBy("node").agg(F.count("*").alias("hidden")), "jaccard-hidden")

    def could(pairs: DataFrame) -> DataFrame:
        """With ``most``: what the prefixes of a and b can share at most, by the ``seen`` tokens and larger keys."""
        of = lambda end: hidden.select(F.col("node").alias(end), F.col("hidden").alias(f"hidden_{end}"))
        most = F.col("seen") + F.least(F.coalesce("hidden_a", F.lit(0)), F.coalesce("hidden_b", F.lit(0)))
        return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").withColumn("most", most)
                .withColumn("keep", _enough(F.col("most") + F.greatest("after_a", "after_b"), F.col("n"), F.col("m"))))

    after = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1
    keep = F.col("keep") & (F.col("i").isNull() | _enough(F.col("most") + after, F.col("n"), F.col("m")))
    tried = write_table(could(pairs).select("a", "b", "first", "seen", keep.alias("keep")), "jaccard-pairs")
    pairs = tried.where("keep and first").select("a", "b")
    links = _verify(pairs, texts, firsts)

    def labels(links: DataFrame) -> DataFrame:
        return write_table(connected_components(links), "jaccard-labels")

    label = labels(links)

    # Keys with more entries: what the slack allows between different components and was not tried yet.
    held = met.where("large and slack + top >= 0").select("key", "node", "n", "slack", "singles")
    held = held.join(label, "node", "left").withColumn("of", F.coalesce("component", "node")).drop("component")
    mixed = held.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo <> hi").select("key")
    held = write_table(held.join(mixed, "key", "left_semi"), "jaccard-large")
    other = held.select("key", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "slack", "singles", "of")))
    rest = (held.join(other, "key").where("node < node2 and of <> of2").where(meets(*map(F.col, ("n", "slack", "n2", "slack2"))))
            .select(F.col("node").alias("a"), F.col("node2").alias("b"), "n", F.col("n2").alias("m"), (F.col("n") - F.col("singles")).alias("after_a"),
                    (F.col("n2") - F.col("singles2")).alias("after_b")).distinct()
            .join(tried, ["a", "b"], "left").where("first is null or (keep and not first)")  # met at no key that could be their first
            .withColumn("seen", F.coalesce("seen", F.lit(0))).drop("keep", "first"))
    rest = could(rest).where("keep").select("a", "b")
    rest = write_table(rest, "jaccard-rest")
    if not rest.isEmpty():
        drop_table(label)
        more = _verify(rest, texts, firsts)
        label = labels(links.union(more))
        drop_table(more)
    for done in (met, hidden, tried, links, held, rest):
        drop_table(done)

    sets_of = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = sets_of.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    component = placed.join(least, "component").select("node", "component_id", F.col("component").alias("group"))
    more = ["print", "group"] if with_groups else []
    size = F.col("n").cast("long").alias("n_shingles")
    full = rows.where("n > 0").join(component, "node").select("doc_id", size, "component_id", *more)
    empty = rows.where("n = 0").withColumn("group", F.lit(None).cast("long"))
    return full.union(empty.select("doc_id", size, F.col("doc_id").alias("component_id"), *more))
