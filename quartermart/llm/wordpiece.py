"""Operator 3: greedy word-piece counts by a linear longest-match automaton.

The vocabulary becomes a byte trie. Every state has a failure link and the
number of pieces that following the link gives up ("pops"), so a word is
counted in one pass over its bytes: match a byte if the trie goes on, else add
the pops of the state and go on from its link. No piece is ever built. A word
that the vocabulary can't spell counts as one unknown piece. Words of any
length are counted, text in scripts without spaces too. ``max_word_bytes``
gives the usual cap of word pieces, by which a longer word is one unknown
piece; None is no cap, and so the query has it.

Vocabularies are public byte-level files (``token rank`` lines, the token in
base 64): a token with a leading space starts a word, one without white space
goes on within it; single bytes do both.

Defined results: a null text has 0 words and 0 tokens; repeated rows are
counted alike; an empty table gives an empty result; other columns pass
through (``n_words`` and ``n_tokens`` are replaced).
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pack, received, send, unpack

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_WORD_BYTES = 200
_MEMO, _MEMO_BYTES = 200_000, 200


def load_vocabulary(path: str = VOCABULARY) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start a word, pieces that go on within one) of a vocabulary file on the driver."""
    with open(path, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    start = {t[1:] for t in tokens if t[:1] == b" " and t[1:].split() == [t[1:]]} | {t for t in tokens if len(t) == 1}
    return start, {t for t in tokens if t.split() == [t]}


class Automaton:
    """Trie over both kinds of pieces with failure links and pop counts.

    ``go``: state * 256 + byte -> state. ``fail`` and ``pops`` by state; a
    state without link has -1. State 0 starts a word, state 1 goes on after
    a piece.
    """

    def __init__(self, start: Iterable[bytes], inner: Iterable[bytes]):
        self.go: dict[int, int] = {}
        depth_done = [False, False]  # whether a piece ends at the state
        for root, pieces in ((0, start), (1, inner)):
            for p in pieces:
                s = root
                for byte in p:
                    t = self.go.get(s << 8 | byte)
                    if t is None:
                        t = self.go[s << 8 | byte] = len(depth_done)
                        depth_done.append(False)
                    s = t
                if s > 1:
                    depth_done[s] = True
        children: dict[int, list[tuple[int, int]]] = {}
        for key, t in self.go.items():
            children.setdefault(key >> 8, []).append((key & 255, t))
        n = len(depth_done)
        self.fail, self.pops = [-1] * n, [0] * n
        todo = deque([0, 1])
        while todo:
            s = todo.popleft()
            for byte, t in children.get(s, ()):
                if depth_done[t]:  # the whole path is one piece: pop it, go on afresh
                    self.fail[t], self.pops[t] = 1, 1
                else:  # pop along the parent's links until some state takes the byte
                    z, popped = self.fail[s], self.pops[s]
                    while z != -1 and (z << 8 | byte) not in self.go:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z != -1:
                        self.fail[t], self.pops[t] = self.go[z << 8 | byte], popped
                todo.append(t)

    def count(self, word: bytes) -> int:
        """Pieces of ``word``; 1 (unknown) if it can't be spelt."""
        go, fail, pops, s, n = self.go, self.fail, self.pops, 0, 0
        for byte in word:
            t = go.get(s << 8 | byte)
            while t is None:
                n += pops[s]
                s = fail[s]
                if s == -1:
                    return 1
                t = go.get(s << 8 | byte)
            s = t
        while s > 1:  # give up what is left
            n += pops[s]
            s = fail[s]
        return n if s == 1 else 1


def count_tokens(docs: DataFrame, vocabulary: tuple[set[bytes], set[bytes]] | None = None,
                 max_word_bytes: int | None = MAX_WORD_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` of ``text``; the vocabulary bounds what is sent out.

    Words longer than ``max_word_bytes`` count as one token; None counts every word's pieces.
    """
    model = send(docs.sparkSession, Automaton(*(vocabulary or load_vocabulary())))

    @F.pandas_udf("n_words long, n_tokens long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = received(model)

        class Memo(dict):  # repeated words are counted once; emptied when full; long words don't enter
            def __missing__(self, word):
                if len(word) > _MEMO_BYTES:
                    return automaton.count(word) if max_word_bytes is None or len(word) <= max_word_bytes else 1
                if len(self) >= _MEMO:
                    self.clear()
                n = self[word] = automaton.count(word) if max_word_bytes is None or len(word) <= max_word_bytes else 1
                return n

        memo = Memo().__getitem__
        for texts in batches:
            words, tokens = [], []
            for text in texts:
                ws = text.encode().split() if text else []
                words.append(len(ws))
                tokens.append(sum(map(memo, ws)))
            yield pd.DataFrame({"n_words": words, "n_tokens": tokens}, dtype="int64")

    counted = pack(docs, "text").withColumn("_c", counts.asNondeterministic()(F.col("text"))).withColumns({"n_words": F.col("_c.n_words"), "n_tokens": F.col("_c.n_tokens")})
    return unpack(counted, docs.columns, ["text"], ["n_words", "n_tokens"])
