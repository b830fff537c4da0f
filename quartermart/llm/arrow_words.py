"""Words of whole texts cut from Arrow buffers: all texts of a piece of a batch at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .shingles import texts_of

#: Classes of bytes: part of a word, white space between words, end of a run of words.
IN_WORD, BLANK, BREAK = 0, 1, 2
PIECE_BYTES = 4 << 20


class Words(NamedTuple):
    """The words of rows [first, first + rows): ``at[r]:at[r + 1]`` are those of the r-th of them."""

    first: int
    rows: int
    at: np.ndarray
    array: pa.LargeBinaryArray  # the words themselves, in order
    joined: np.ndarray          # whether word i + 1 goes on the run of word i
    clean: np.ndarray           # the bytes with every separator as a space
    offsets: np.ndarray         # of the rows in ``clean``


def byte_classes(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[list(blanks)] = BLANK
    kind[list(breaks)] = BREAK
    return kind


def words_of(column: pa.Array, kind: np.ndarray, lower: bool = False, piece: int = PIECE_BYTES,
             cuts_in: Callable[[np.ndarray], np.ndarray] | None = None, intact: bytes = b"") -> Iterator[Words]:
    """Pieces of about ``piece`` bytes, whole texts each; null is an empty text; ``lower`` lower-cases A-Z.

    ``cuts_in`` marks bytes at which a word is cut further. Words with the two bytes ``intact`` are neither cut nor lower-cased.
    """
    data, offsets = texts_of(column)
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    fold[kind != IN_WORD] = 32
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece, "right")) - 1)
        raw, cuts = data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        kinds = kind[raw]
        inside = kinds == IN_WORD
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        borders = cuts[1:-1][(cuts[1:-1] > 0) & (cuts[1:-1] < len(raw))]
        starts[borders] = inside[borders]
        ends[borders - 1] = inside[borders - 1]
        clean = fold[raw]
        if cuts_in:
            cut = cuts_in(raw) & inside
            hits = np.flatnonzero((raw[:-1] == intact[0]) & (raw[1:] == intact[1])) if intact else ()
            if len(hits):
                first, last = np.flatnonzero(starts), np.flatnonzero(ends)
                held = np.unique(np.searchsorted(first, hits, "right") - 1)
                depth = np.zeros(len(raw) + 1, np.int32)
                depth[first[held]] += 1
                depth[last[held] + 1] -= 1
                keep = np.cumsum(depth[:-1]) > 0
                cut &= ~keep
                clean[keep] = raw[keep]
            starts |= cut
            ends[:-1] |= cut[1:] & inside[:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
        bounds = np.concatenate(([0], np.cumsum(ends - starts + 1)))
        array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(clean[inside])])
        at = np.searchsorted(starts, cuts)
        joined = np.ones(len(starts), bool)
        joined[at[1:][at[1:] > 0] - 1] = False
        stops = np.flatnonzero(kinds == BREAK)
        if len(stops):
            behind = np.searchsorted(stops, starts)
            joined[:-1] &= behind[1:] == behind[:-1]
        yield Words(row, end - row, at, array, joined, clean, cuts)
        row = end
