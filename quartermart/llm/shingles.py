"""Words and word shingles of whole texts as 64-bit hashes, computed over Arrow buffers.

A word's hash is a polynomial over its bytes (A-Z lower-cased), a shingle's
hash mixes those of its words; both are finished by a bijective mixer. All
texts of a piece of a batch are hashed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
_PIECE = 1 << 18  # bytes hashed at once, which take some 35 times as much memory; a longer text is cut between words
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
        h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
        return h ^ (h >> _U(32))


class Hasher:
    """Tables for hashing: a value for each byte, powers of an odd base and their inverses."""

    def __init__(self, seed: int = 20):
        r = np.random.default_rng(seed)
        self.value = r.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
        self.value[65:91] = self.value[97:123]
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.value[self.space] = 0
        self.base = int(r.integers(1 << 60, 1 << 63)) | 1
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.factor = r.integers(1 << 60, 1 << 63, WORDS + 1, dtype=np.uint64) | _U(1)

    def _powers(self, n: int) -> None:
        step = [self.base, pow(self.base, -1, 1 << 64)]
        with np.errstate(over="ignore"):
            while len(self.power) < n:
                k = len(self.power)
                self.power = np.concatenate((self.power, self.power * _U(pow(step[0], k, 1 << 64))))
                self.inverse = np.concatenate((self.inverse, self.inverse * _U(pow(step[1], k, 1 << 64))))

    def words(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the words of ``data``, their starts); a word also ends at each of ``breaks``."""
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._powers(len(data))
        space = self.space[data]
        first = ~space
        first[1:] &= space[:-1]
        breaks = breaks[breaks < len(data)]
        first[breaks] = ~space[breaks]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(self.value[data] * self.power[: len(data)], starts)
            return mix(sums * self.inverse[starts]), starts

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes [start, end) of ``data``, none empty, each behind the one before."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._powers(len(data))
        with np.errstate(over="ignore"):
            values = np.append(self.value[data] * self.power[: len(data)], _U(0))
            sums = np.add.reduceat(values, np.stack((starts, ends), 1).ravel())[::2]
            return mix(sums * self.inverse[starts])

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Hashes of all runs of five words (of the whole sequence, if shorter), in order."""
        n = min(len(words), WORDS)
        if not n:
            return words
        with np.errstate(over="ignore"):
            h = np.full(len(words) - n + 1, n, np.uint64) * self.factor[WORDS]
            for j in range(n):
                h += words[j:len(words) - n + 1 + j] * self.factor[j]
        return mix(h)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def pieces(data: np.ndarray, lo: int, hi: int, space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of the bytes [lo, hi) of a text that end after a white space."""
    while lo < hi:
        stop = min(hi, lo + _PIECE)
        while stop < hi:
            blank = np.flatnonzero(space[data[max(lo, stop - 65536):stop]])
            if len(blank):
                stop = max(lo, stop - 65536) + int(blank[-1]) + 1
                break
            stop = min(hi, stop + 65536)
        yield lo, stop
        lo = stop


def word_hashes(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of all its words) for every row of a string column."""
    data, offsets = texts_of(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[end])
        if hi - lo <= _PIECE or end > row + 1:
            cuts = offsets[row:end + 1] - lo
            words, starts = hasher.words(data[lo:hi], cuts[:-1])
            at = np.searchsorted(starts, cuts)
            for i in range(end - row):
                yield row + i, words[at[i]:at[i + 1]]
        else:  # one long text
            parts = [hasher.words(data[a:b], np.zeros(1, np.int64))[0] for a, b in pieces(data, lo, hi, hasher.space)]
            yield row, np.concatenate(parts)
        row = end
