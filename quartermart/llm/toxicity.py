"""Operator 8: toxicity by a bidirectional gated recurrent network, in numpy.

Each word enters as a hashed word vector next to the mean of its hashed
letter-trigram vectors (characters and words). Two gated recurrent layers read
a window forwards and backwards, attention pools their states, and a logistic
unit scores the window. A text is scored by the largest score over all its
overlapping windows, so nothing is cut off; a logistic fit over the training
documents turns that into a probability.

Training runs on the driver over a bounded sample of labelled rows: about
``train_docs`` documents of each label, chosen by a hash of the id, of at most
``max_train_chars`` characters. A toxic document need not be toxic throughout,
so each epoch learns from its highest-scoring windows, and from the highest
and some other windows of clean documents. Seeds are fixed and rows are
sorted, so reruns agree.

Defined results: a null or empty text scores 0; without labelled rows of both
kinds every score is 0; a row labelled more than once counts with its largest
label, labels other than 0 and 1 are ignored; of repeated ids the smallest text
is learnt from, so the sample is bounded by rows; repeated rows are scored alike;
ids are kept exactly, beside null ids too; a text of any length is scored over the
windows of ``window_starts`` of all its words; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, received, send

TRAIN_DOCS = 1500
MAX_TRAIN_CHARS = 50_000
WINDOW, STRIDE = 40, 32
THRESHOLD = 0.3
BUCKETS = 1 << 14
EMBED, HIDDEN = 8, 8
EPOCHS, BATCH, RATE = 12, 192, 1e-2
_MEMO = 150_000
_AT_ONCE = 4096  # windows scored together
_PIECE = 3000  # windows of one text whose words are looked up together


def word_keys(word: str) -> tuple[int, list[int]]:
    """(bucket of the word, buckets of its letter trigrams); 0 is kept for "nothing"."""
    w = word.lower().strip(".,;:!?\"'()[]*#$%&")
    padded = f"<{w}>".encode()
    bucket = lambda b: zlib.crc32(b) % (BUCKETS - 1) + 1
    return bucket(padded), [bucket(padded[i:i + 3]) for i in range(max(1, len(padded) - 2))]


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows over ``n`` words; the last one ends at the end."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW))


class Words(NamedTuple):
    """Distinct words: bucket of each, buckets of all their trigrams in a row, number of trigrams of each."""

    word: np.ndarray
    tri: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, keys: list[tuple[int, list[int]]]) -> Words:
        return cls(np.array([w for w, _ in keys], np.int32), np.array([t for _, ts in keys for t in ts], np.int32),
                   np.array([len(ts) for _, ts in keys], np.int64))

    def take(self, rows: np.ndarray) -> Words:
        n = self.n[rows]
        first = np.repeat((np.cumsum(self.n) - self.n)[rows] - (np.cumsum(n) - n), n)
        return Words(self.word[rows], self.tri[first + np.arange(len(first))], n)


def _sum_rows(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` that share an index."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        at = index[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = np.add.reduceat(values[order], first)
    return out


class Network:
    """Parameters ``p`` and the passes forwards and backwards."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        make = lambda *shape, s: (r.standard_normal(shape) * s).astype(np.float32)
        h, x = HIDDEN, 2 * EMBED
        self.p = {"word": make(BUCKETS, EMBED, s=0.3), "tri": make(BUCKETS, EMBED, s=0.5),
                  "in": make(2, x, 3 * h, s=x ** -0.5), "in_b": np.zeros((2, 3 * h), np.float32),
                  "rec": make(2, h, 3 * h, s=h ** -0.5), "att": make(2 * h, s=0.1),
                  "out": make(2 * h, s=0.3), "out_b": np.zeros(1, np.float32)}
        self.p["word"][0] = self.p["tri"][0] = 0

    def features(self, words: Words) -> np.ndarray:
        """Word vector and mean trigram vector of each word."""
        first = np.cumsum(words.n) - words.n
        mean = np.add.reduceat(self.p["tri"][words.tri], first) / words.n[:, None].astype(np.float32)
        return np.concatenate((self.p["word"][words.word], mean), 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input side of both layers: (words, 2, 3 h)."""
        return np.stack([x @ self.p["in"][d] + self.p["in_b"][d] for d in (0, 1)], 1)

    def states(self, proj: np.ndarray, rows: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (steps, windows, 2 h) of both layers; ``keep`` gets what the way back needs."""
        b, steps = rows.shape
        h2 = 2 * HIDDEN
        out = np.empty((steps, b, h2), np.float32)
        for d in (0, 1):
            h, rec, side = np.zeros((b, HIDDEN), np.float32), self.p["rec"][d], np.ascontiguousarray(proj[:, d])
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, u = side[rows[:, t]], h @ rec
                gates = x[:, :h2] + u[:, :h2]
                gates *= 0.5
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, h2:] + r * u[:, h2:])
                before = h
                h = new + z * (before - new)
                if mask is not None:
                    h *= mask[:, t, None]
                out[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
                if keep is not None:
                    keep.append((d, t, before, z, r, new, u[:, h2:]))
        return out

    def pool(self, out: np.ndarray, mask: np.ndarray | None):
        a = out @ self.p["att"]
        if mask is not None:
            a = np.where(mask.T > 0, a, -1e9)
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbh->bh", a, out)
        return a, pooled, pooled @ self.p["out"] + self.p["out_b"][0]

    def logits(self, proj: np.ndarray, rows: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        return self.pool(self.states(proj, rows, mask), mask)[2]

    def gradient(self, words: Words, rows, mask, y, weight) -> dict:
        """Gradient of the weighted log loss over windows ``rows`` (indices into ``words``)."""
        p, b = self.p, len(rows)
        x = self.features(words)
        keep: list = []
        out = self.states(self.project(x), rows, mask, keep)
        a, pooled, logit = self.pool(out, mask)
        dl = ((1 / (1 + np.exp(-logit)) - y) * weight / b).astype(np.float32)
        g = {"out": dl @ pooled, "out_b": np.array([dl.sum()], np.float32)}
        dpool = dl[:, None] * p["out"]
        da = np.einsum("bh,tbh->tb", dpool, out)
        dscore = a * (da - (a * da).sum(0))
        g["att"] = np.einsum("tb,tbh->h", dscore, out)
        dout = a[:, :, None] * dpool + dscore[:, :, None] * p["att"]
        g["in"], g["in_b"], g["rec"] = np.zeros_like(p["in"]), np.zeros_like(p["in_b"]), np.zeros_like(p["rec"])
        dx = np.zeros_like(x)
        for d in (0, 1):
            dh, dside = np.zeros((b, HIDDEN), np.float32), np.zeros((len(rows[0]), b, 3 * HIDDEN), np.float32)
            for dd, t, before, z, r, new, un in reversed([k for k in keep if k[0] == d]):
                dh = (dh + dout[t, :, d * HIDDEN:(d + 1) * HIDDEN]) * mask[:, t, None]
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (before - new) * z * (1 - z)
                dr = dnew * un * r * (1 - r)
                side = np.concatenate((dz, dr, dnew), 1)
                du = np.concatenate((dz, dr, dnew * r), 1)
                dside[t] = side
                g["rec"][d] += before.T @ du
                dh = dh * z + du @ p["rec"][d].T
            dproj = _sum_rows(rows.T.ravel(), dside.reshape(-1, 3 * HIDDEN), len(x))
            g["in"][d], g["in_b"][d] = x.T @ dproj, dproj.sum(0)
            dx += dproj @ p["in"][d].T
        g["word"] = (words.word, dx[:, :EMBED])
        g["tri"] = (words.tri, np.repeat(dx[:, EMBED:] / words.n[:, None].astype(np.float32), words.n, axis=0))
        return g


class _Adam:
    def __init__(self, p: dict):
        self.m, self.v, self.t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        fix = (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for k in p:
            dense = _sum_rows(*g[k], len(p[k])) if k in ("word", "tri") else g[k]
            self.m[k] += 0.1 * (dense - self.m[k])
            square = dense * dense
            if k in ("word", "tri"):  # one scale for the table: rare words move little, words of many windows much
                square = square.sum() / max(1, np.count_nonzero(dense))
            self.v[k] += 0.001 * (square - self.v[k])
            p[k] -= rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)
        p["word"][0] = p["tri"][0] = 0


def _windows(texts: list[str]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the distinct words after "nothing", rows, mask, document) of all windows of ``texts``."""
    ids, keys, rows, doc = {}, [(0, [0])], [], []
    for i, text in enumerate(texts):
        seq = []
        for w in text.split():
            if w not in ids:
                ids[w] = len(keys)
                keys.append(word_keys(w))
            seq.append(ids[w])
        for s in window_starts(len(seq)):
            part = seq[s:s + WINDOW]
            rows.append(part + [0] * (WINDOW - len(part)))
            doc.append(i)
    rows = np.array(rows, np.int64).reshape(-1, WINDOW)
    return keys, rows, (rows > 0).astype(np.float32), np.array(doc, np.int64)


def train(texts: list[str], y: np.ndarray, share: float, seed: int = 7) -> tuple[Network, float, float]:
    """(network, slope, offset): the fit over ``texts`` with labels ``y``; ``share``: of label 1 among all rows."""
    net, r = Network(seed), np.random.default_rng(seed)
    keys, rows, mask, doc = _windows(texts)
    words = Words.of(keys)
    adam, yw = _Adam(net.p), y[doc].astype(np.float32)
    balance = np.where(yw == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)

    def all_logits() -> np.ndarray:
        proj = net.project(net.features(words))
        return np.concatenate([net.logits(proj, rows[i:i + _AT_ONCE], mask[i:i + _AT_ONCE]) for i in range(0, len(rows), _AT_ONCE)])

    def place_in_doc(value: np.ndarray) -> np.ndarray:
        """0 for the first window of its document by falling ``value``, and so on."""
        order = np.lexsort((-value, doc))
        first = np.flatnonzero(np.diff(doc[order], prepend=-1))
        place = np.empty(len(doc), np.int64)
        place[order] = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
        return place

    for epoch in range(EPOCHS):
        if epoch < 3:
            use = place_in_doc(r.random(len(doc))) < 3
        else:
            hard = place_in_doc(all_logits())
            some = place_in_doc(r.random(len(doc)))
            use = (hard < 2) | ((yw == 0) & (some < 1))
        picked = r.permutation(np.flatnonzero(use))
        for i in range(0, len(picked), BATCH):
            w = picked[i:i + BATCH]
            own, local = np.unique(rows[w], return_inverse=True)
            rate = RATE * min(1.0, 2 * (1 - epoch / EPOCHS))
            adam.step(net.p, net.gradient(words.take(own), local.reshape(len(w), -1), mask[w], yw[w], balance[w]), rate)
    best = np.full(len(texts), -20.0)
    np.maximum.at(best, doc, all_logits())
    weight = np.where(y == 1, share / max(y.mean(), 1e-6), (1 - share) / max(1 - y.mean(), 1e-6))
    slope, offset, centre = 1.0, 0.0, best.mean()
    for _ in range(50):  # Newton steps of a logistic fit, slightly held towards slope 1
        q = 1 / (1 + np.exp(-(slope * (best - centre) + offset)))
        d, s = weight * (q - y), weight * q * (1 - q) + 1e-9
        x = best - centre
        grad = np.array([d @ x + 0.5 * (slope - 1), d.sum()])
        hess = np.array([[s @ (x * x) + 0.5, s @ x], [s @ x, s.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        slope, offset = slope - np.clip(step[0], -0.5, 0.5), offset - np.clip(step[1], -1, 1)
    return net, float(slope), float(offset - slope * centre)


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, max_train_chars: int = MAX_TRAIN_CHARS):
    """A trained (network, slope, offset) from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without both labels."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    numbers = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(numbers) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    rate = F.when(F.col("toxic") == 1, train_docs / numbers[1]).otherwise(train_docs / numbers[0])
    sample = known.where(draw < rate)  # about 2 * train_docs rows
    rows = (docs.where(F.length("text").between(1, max_train_chars)).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).toPandas().sort_values("doc_id"))
    if rows["toxic"].nunique() < 2:
        return None
    return train(rows["text"].tolist(), rows["toxic"].to_numpy(np.float32), numbers[1] / sum(numbers.values()))


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, score, predicted, n_windows) over all windows of every whole text."""
    sent = send(docs.sparkSession, model)  # of fixed size

    @F.pandas_udf("score double, predicted int, n_windows long")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        got = received(sent)
        if got is None:
            for b in batches:
                yield pd.DataFrame({"score": np.zeros(len(b)), "predicted": np.zeros(len(b), np.int32), "n_windows": np.zeros(len(b), np.int64)})
            return
        net, slope, offset = got
        width = 3 * HIDDEN
        empty = net.project(net.features(Words.of([(0, [0])]))).reshape(1, 2 * width)
        memo, proj = {}, empty

        def logits(rows: list[np.ndarray]) -> np.ndarray:
            m = np.concatenate(rows)
            full = (m > 0).all(1)
            p3, got = proj[: len(memo) + 1].reshape(-1, 2, width), np.empty(len(m))
            for part, masked in ((np.flatnonzero(full), False), (np.flatnonzero(~full), True)):
                for i in range(0, len(part), _AT_ONCE):
                    w = m[part[i:i + _AT_ONCE]]
                    got[part[i:i + _AT_ONCE]] = net.logits(p3, w, (w > 0).astype(np.float32) if masked else None)
            return got

        for b in batches:
            best, number = np.full(len(b), -np.inf), np.zeros(len(b), np.int64)
            rows, owner, held = [], [], 0

            def flush():
                nonlocal rows, owner, held
                if rows:
                    np.maximum.at(best, np.concatenate(owner), logits(rows))
                rows, owner, held = [], [], 0

            for i, text in enumerate(b):
                words = (text or "").split()
                starts = window_starts(len(words))
                number[i] = len(starts)
                for k in range(0, len(starts), _PIECE):  # keeps a huge text's word table small
                    at = starts[k:k + _PIECE]
                    part = words[at[0]:at[-1] + WINDOW]
                    new = [w for w in dict.fromkeys(part) if w not in memo]
                    if len(memo) + len(new) > _MEMO:
                        flush()
                        memo, proj = {}, empty
                        new = list(dict.fromkeys(part))
                    if new:
                        first = len(memo) + 1
                        memo.update((w, first + j) for j, w in enumerate(new))
                        if len(proj) < len(memo) + 1:
                            proj = np.concatenate((proj, np.zeros((max(len(proj), len(memo) + 1 - len(proj)), 2 * width), np.float32)))
                        for j in range(0, len(new), 20_000):
                            keys = [word_keys(w) for w in new[j:j + 20_000]]
                            proj[first + j:first + j + len(keys)] = net.project(net.features(Words.of(keys))).reshape(-1, 2 * width)
                    seq = np.fromiter(map(memo.__getitem__, part), np.int64, len(part))
                    span = (at - at[0])[:, None] + np.arange(WINDOW)
                    rows.append(np.where(span < len(seq), seq[np.minimum(span, len(seq) - 1)], 0))
                    owner.append(np.full(len(at), i))
                    held += len(at)
                    if held >= 4 * _AT_ONCE:
                        flush()
            flush()
            s = 1 / (1 + np.exp(-np.clip(slope * best + offset, -60, 60)))
            s = np.where(number > 0, s, 0.0)
            yield pd.DataFrame({"score": s, "predicted": (s >= threshold).astype(np.int32), "n_windows": number})

    judged = docs.select("doc_id", judge.asNondeterministic()(F.col("text")).alias("_s"))
    return judged.select("doc_id", "_s.score", "_s.predicted", "_s.n_windows")


def judge_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the rows not held out, then score every row; adds ``held_out``."""
    model = learn(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
