"""Operator 12: fill-in-the-middle texts, cut by an indexable skip list.

A text is a list of units (runs of ASCII letters, and every other code point by
itself). Over the units stands a skip list: a unit of height h is on lanes 0 to
h, a quarter of the units of a lane being on the next one, and every link
carries how many units and how many code points it passes. A cut after r units
is found by going down from the highest lane, along a link while the units
passed stay within r; the code points passed by then are where the text is cut.
Both ranks are exact, however long the text is, in a number of steps that grows
with its logarithm.

What happens to a document follows from its id alone (``draw``): four unsigned
integers from a SHA-256. Two give the cuts, one whether the text stays plain, one
the order of the parts.

Defined results: null is an empty text; a text that is empty or holds a sentinel
stays plain, with null lengths; a null doc_id is drawn as the empty text;
repeated rows come out alike; other columns pass through, but for the names of
the operator's own, which are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pack, unpack

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts with another form than plain, and of those in suffix-first order.
FIM_PERCENT, SPM_PERCENT = 90, 20
SEED = "1"
PLAIN, PSM, SPM = "plain", "psm", "spm"
OWN = ["n", "form", "prefix_chars", "middle_chars", "output"]


def unit_starts(text: str) -> np.ndarray:
    """Code points at which the units ``[A-Za-z]+|[^A-Za-z]`` of ``text`` start."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = ((c | 32) >= 97) & ((c | 32) <= 122)
    starts = np.ones(len(c), bool)
    starts[1:] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def _coins(n: int, seed: int = 12) -> np.ndarray:
    """Heights: how often in a row a coin of one quarter falls, the same for every text."""
    return np.random.default_rng(seed).geometric(0.75, n) - 1


class UnitList:
    """Skip list over units with unit-width and code-point-width on every link of every lane."""

    heights = _coins(1 << 16)

    def __init__(self, widths: np.ndarray):
        """``widths``: code points of each unit, in order."""
        self.lanes = [([1] * len(widths), widths.tolist(), None)]  # unit-widths, code-point-widths, place on the lane below
        units, points = np.ones(len(widths), np.int64), widths
        height = np.resize(self.heights, len(widths)) if len(widths) else np.zeros(0, np.int64)
        lane = 1
        while len(height) > 1:
            up = height >= lane
            up[0] = True  # the head is on every lane
            below = np.flatnonzero(up)
            if len(below) == len(height):
                if lane > 64:
                    break
                lane += 1
                continue
            # a link of a lane passes all links of the lane below between its ends
            units, points, height = np.add.reduceat(units, below), np.add.reduceat(points, below), height[below]
            self.lanes.append((units.tolist(), points.tolist(), below.tolist()))
            lane += 1

    def seek(self, rank: int) -> int:
        """Code points before the unit of that rank (all of them, for the rank behind the last)."""
        at, units, points = 0, 0, 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            unit_width, point_width, below = self.lanes[lane]
            while at < len(unit_width) and units + unit_width[at] <= rank:
                units += unit_width[at]
                points += point_width[at]
                at += 1
            if units == rank:
                return points
            at = below[at] if below else at
        return points


def draw(doc_id: int | None, seed: str = SEED) -> tuple[int, ...]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k:k + 8], 16) for k in (0, 8, 16, 24))


def fill_middle(text: str, draws: tuple[int, ...]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    starts = unit_starts(text)
    n = len(starts)
    if not text or draws[2] % 100 >= FIM_PERCENT or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    units = UnitList(np.diff(starts, append=len(text)))
    a, b = (units.seek(r) for r in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < SPM_PERCENT:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that ``output`` came from. A sentinel can't arise where two parts meet, so the first one is the border."""
    if form == PLAIN:
        return output
    first, _, rest = output[len(PREFIX):].partition(SUFFIX if form == PSM else PREFIX)
    second, _, middle = rest.partition(MIDDLE)
    return first + middle + second if form == PSM else second + middle + first


def to_fill_middle(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output."""

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:  # the id comes as text: null next to large numbers would round them
            rows = [fill_middle(t or "", draw(i, seed)) for i, t in zip(ids, texts, strict=True)]
            yield pd.DataFrame(rows, columns=OWN).astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    made = pack(docs, "doc_id", "text").withColumn("_made", cut.asNondeterministic()(F.col("doc_id").cast("string"), F.col("text")))
    made = made.select("doc_id", "text", "_row", *(F.col("_made").getField(c).alias(c) for c in OWN))
    return unpack(made, docs.columns, ["doc_id", "text"], OWN)


def restored(output: Column, form: Column) -> Column:
    """The exact text again, from output and form alone."""

    @F.pandas_udf("string")
    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)
