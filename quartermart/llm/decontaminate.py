"""Operator 5: benchmark decontamination by template canonicalisation.

Words are reduced to templates: numbers, units, numbers with a unit, and names
become typed placeholders, other words lose case and outer punctuation. A
capitalised word is a name unless its lower-case form occurs as a word of the
benchmark. Hashes of windows of ``WINDOW`` template words of a document are
looked up among those of the benchmark items; hits of one item at one shift
form an alignment, and so does a chain of hits of neighbouring shifts in which
both places grow: names side by side are one name and a number and its unit
are one, so a slot may get another number of words, and further words may be
put in (shifts may drift by the item's length). Its slots must be consistent: a value that fills
placeholders of the item may be replaced by one other value throughout, so
windows whose slot disagrees with the usual replacement do not count. An
alignment that keeps at least half of the item's windows is a leak, whether
word for word or with new numbers, names and units. Windows with fewer than
three ordinary words are too common to be looked up; at the shifts that the
others give they are compared directly and count like them.

Windows of the words themselves, case aside, are looked up besides, so copies
word for word are found of any item, be it all figures or names; half of them
at one shift is a leak too.

The benchmark is cut into slices of at most about ``SLICE_BYTES`` of text by a
hash of its rows. Each slice's index is sent to all tasks, and one Python worker
a task looks a text up in all of them: what is sent out, and a worker's memory,
grow with the benchmark (not with the documents). What is a name is told by the
whole benchmark, so the number of slices changes no result. Windows are looked
up for many texts at once, in their bytes; only texts that share as many with
an item as a leak needs are cut into words and aligned with it. Ordinary words
that the benchmark lacks equal no word of it and need no ids.

Defined results: null and empty texts and items match nothing; an item of
fewer words than a window has one, the whole item, so an item of one word is in
every text with that word; an item without a window of three ordinary words
(all, if shorter) is found word for word only; repeated rows and items are judged alike; an
empty table on either side gives no leaks; other columns pass through, one
named leaks is replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pack, received, send, unpack
from .shingles import Hasher, mix, pieces, texts_of

WINDOW = 5
LITERALS = 3
SHARE = 0.5
SLICE_BYTES = 8_000_000
_MEMO = 200_000
_PIECE = 400_000  # words of one text handled at once; pieces overlap by an item's length
_GROUP = 1 << 18  # bytes of short texts looked up at once
_HITS = 1 << 21  # hits counted at once; where they are more, texts are aligned without a count
#: Words for units of measure.
UNITS = frozenset("""
mm cm m km in inch inches ft foot feet yd yard yards mile miles meter meters metre metres kilometer kilometers kilometre
kilometres mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne tonnes ml l liter liters
litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hrs hour hours day days week weeks month
months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh kph w kw kwh v hz khz mhz ghz
kb mb gb tb byte bytes
""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
_NUMBER_UNIT = re.compile(r"([+-]?\d[\d.,]*)([a-z]+)")
_EDGE = ".,;:!?\"'()[]{}<>*#&|`~_=…«»“”‘’"
NUMBER, UNIT, NUMBER_UNIT, NAME = 1, 2, 3, 4  # template ids; ordinary words have larger ones, 0 is nothing
OTHER = np.uint64(8)  # both ids of ordinary words that no item has


def _hash(text: str) -> int:
    data = text.encode("utf-8", "replace")
    return (zlib.crc32(data) << 32 | zlib.adler32(data, len(data))) + 16


def placeholder(w: str, low: str, common: frozenset[str]) -> int:
    """Template id of a number, unit, number with a unit or name; 0 for an ordinary word."""
    if low in UNITS:
        return UNIT
    if not w.isalpha():
        if _NUMBER.fullmatch(w):
            return NUMBER
        if (m := _NUMBER_UNIT.fullmatch(low)) and m[2] in UNITS:
            return NUMBER_UNIT
    return NAME if len(w) > 1 and w[0].isupper() and w[1:].islower() and low not in common else 0


class Templates(dict):
    """Template and value ids of words, with a bounded memory of words seen: word -> its place in ``ids``."""

    def __init__(self, common: frozenset[str], known: frozenset[str] | None = None):
        """``known``: the words of all items (see ``item_words``); ordinary words beside them are ``OTHER``. None: every word has ids."""
        self.common, self.known = common, known
        self.ids = array("Q", (int(OTHER), int(OTHER), 0, 0))

    def __missing__(self, word: bytes) -> int:
        w = word.decode("utf-8", "replace").strip(_EDGE)
        low = w.lower()
        if not w:
            place = 1  # punctuation alone
        else:
            kind = placeholder(w, low, self.common)
            if not kind and self.known is not None and low not in self.known:
                place = 0
            else:
                place, value = len(self.ids) >> 1, _hash(low)
                self.ids.extend((kind or value, value))
        self[word] = place
        return place

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """(words, 2): template id and value id of each word."""
        if len(self) > _MEMO:
            self.clear()
            del self.ids[4:]
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.ids, np.uint64).reshape(-1, 2)[places]


_FACTORS = np.random.default_rng(5).integers(1 << 60, 1 << 63, WINDOW + 1, dtype=np.uint64) | np.uint64(1)


def windows(template: np.ndarray, size: int = WINDOW, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all runs of ``size`` template ids, or of those that start ``at`` some."""
    n = max(0, len(template) - size + 1) if at is None else len(at)
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64) * _FACTORS[WINDOW]
        for j in range(size if n else 0):
            h += (template[j:n + j] if at is None else template[at + j]) * _FACTORS[j]
    return mix(h)


_COPY = np.uint64(0xA5A5A5A5A5A5A5A5)  # keeps windows of values apart from windows of templates
_ODD = np.uint64(0x9E3779B97F4A7C15)


def collapsed(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Template ids with names side by side as one name, a number and its unit as one; and the place of each one's first word."""
    joins = (kind[1:] == NAME) & (kind[:-1] == NAME) | (kind[1:] == UNIT) & (kind[:-1] == NUMBER)
    if not joins.any():
        return kind, np.arange(len(kind))
    first = np.flatnonzero(np.concatenate(([True], ~joins)))
    out, size = kind[first], np.diff(np.append(first, len(kind)))
    out[(size > 1) & (out == NUMBER)] = NUMBER_UNIT
    return out, first


def collapse(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of template and value ids."""
    kind, first = collapsed(ids[:, 0])
    if len(first) == len(ids):
        return ids, first
    size = np.diff(np.append(first, len(ids)))
    nth = (np.arange(len(ids)) - np.repeat(first, size)).astype(np.uint64)
    out = ids[first]
    out[:, 0] = kind
    with np.errstate(over="ignore"):
        value = np.add.reduceat(mix(ids[:, 1] + nth * _ODD), first)
    out[:, 1] = np.where(size > 1, value | np.uint64(16), out[:, 1])
    return out, first


class Table:
    """Hashes of windows with the item and the place they stand at."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray, np.ndarray]], need: list[float]):
        """``rows``: item, window size, places, hashes. ``need``: how many of them a text must have for a leak of the item, by item."""
        self.need = np.array(need)
        none = np.zeros(0, np.int64)
        h = np.concatenate([r[3] for r in rows]) if rows else none.astype(np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.concatenate([np.full(len(r[2]), r[0]) for r in rows])[order] if rows else none
        self.place = np.concatenate([r[2] for r in rows])[order] if rows else none
        self.sizes = sorted({r[1] for r in rows if len(r[2])})
        self.size_of = {r[0]: r[1] for r in rows}
        self.maybe = np.zeros(1 << 21, bool)
        self.maybe[(self.hashes >> np.uint64(43)).astype(np.int64)] = True

    def texts(self, values: np.ndarray, skip: np.uint64, text: np.ndarray) -> np.ndarray:
        """Numbers in ``text`` (by place in ``values``) of all texts with as many windows as some item needs; no item has the value ``skip``."""
        out, none, items = [], np.concatenate(([0], np.cumsum(values == skip))), len(self.need)
        for size in self.sizes:
            pos = np.flatnonzero(none[size:] == none[:-size])
            h = windows(values, size, pos)
            few = np.flatnonzero(self.maybe[(h >> np.uint64(43)).astype(np.int64)])
            lo, hi = np.searchsorted(self.hashes, h[few], "left"), np.searchsorted(self.hashes, h[few], "right")
            found, lo, n = text[pos[few[hi > lo]]], lo[hi > lo], (hi - lo)[hi > lo]
            if n.sum() > _HITS:
                out.append(found)  # too many to count, so all of them are aligned
                continue
            entry = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
            pairs = np.unique(np.repeat(found, n) * len(self.hashes) + entry)
            owners, n = np.unique(pairs // max(1, len(self.hashes)) * items + self.owner[pairs % max(1, len(self.hashes))], return_counts=True)
            out.append(owners[n >= self.need[owners % items]] // items)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def hits(self, values: np.ndarray) -> dict[int, dict[int, set[int]]]:
        """item -> shift -> places of the item's windows found in ``values``."""
        found: dict[int, dict[int, set[int]]] = {}
        for size in self.sizes:
            h = windows(values, size)
            pos = np.flatnonzero(self.maybe[(h >> np.uint64(43)).astype(np.int64)])
            if not len(pos):
                continue
            lo, hi = np.searchsorted(self.hashes, h[pos], "left"), np.searchsorted(self.hashes, h[pos], "right")
            for p, a, b in zip(pos[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for o, j in zip(self.owner[a:b].tolist(), self.place[a:b].tolist()):
                    if self.size_of[o] == size:
                        found.setdefault(o, {}).setdefault(p - j, set()).add(j)
        return found


def lower_words(texts: Iterable[str | None]) -> frozenset[str]:
    """Distinct words in lower case: no such word is a name elsewhere."""
    return frozenset(s for text in texts for w in (text or "").encode().split()
                     if (s := w.decode("utf-8", "replace").strip(_EDGE)) and s == s.lower())


def item_words(texts: Iterable[str | None]) -> frozenset[str]:
    """Distinct words of items without case and outer punctuation."""
    return frozenset(w.decode("utf-8", "replace").strip(_EDGE).lower() for text in texts for w in (text or "").encode().split())


class Index:
    """Windows of the items of one slice: of templates, and of the words themselves."""

    def __init__(self, items: list[tuple[int | None, str]], common: frozenset[str] | None = None):
        """``common``: lower-case words of the whole benchmark, if ``items`` is a part of it."""
        raw = [(i, [w for w in (text or "").encode().split()]) for i, text in items]
        self.common = lower_words(text for _, text in items) if common is None else common
        template = Templates(self.common)
        self.items, likes, copies = [], [], []
        self.longest = 0
        for o, (item, ws) in enumerate(raw):
            words = template(ws) if ws else np.zeros((0, 2), np.uint64)
            words = words[words[:, 0] != 0]
            ids, _ = collapse(words)
            size = min(WINDOW, len(ids))
            ordinary = ids[:, 0] > NAME
            n = len(ids) - size + 1 if size else 0
            use = np.array([j for j in range(n) if ordinary[j:j + size].sum() >= min(LITERALS, size)], np.int64)
            raw_size = min(WINDOW, len(words))
            self.items.append((item, ids, size, n, len(words) - raw_size + 1))
            self.longest = max(self.longest, len(words))
            if len(use):
                likes.append((o, size, use, windows(ids[:, 0], size)[use]))
            if raw_size:
                h = windows(words[:, 1] ^ _COPY, raw_size)
                copies.append((o, raw_size, np.arange(len(h)), h))
        self.rich = {o: len(use) for o, _, use, _ in likes}
        self.likes = Table(likes, [SHARE * n - (n - self.rich.get(o, 0)) for o, (_, _, _, n, _) in enumerate(self.items)])
        self.copies = Table(copies, [SHARE * n for *_, n in self.items])


def _consistent(item: np.ndarray, doc: np.ndarray, at: list[tuple[int, int]], size: int) -> tuple[int, bool]:
    """(windows ``at`` (place in the item, place in the text) whose slots agree with the usual replacement, whether nothing was replaced)."""
    covered = sorted({(j + k, p + k) for j, p in at for k in range(size)})
    used = defaultdict(Counter)
    for j, p in covered:
        if item[j, 0] <= NAME:
            used[int(item[j, 0]), int(item[j, 1])][int(doc[p, 1])] += 1
    usual = {k: max(c, key=lambda v: (c[v], v)) for k, c in used.items()}
    ok = {(j, p) for j, p in covered if item[j, 0] > NAME or usual[int(item[j, 0]), int(item[j, 1])] == int(doc[p, 1])}
    kept = [(j, p) for j, p in at if all((j + k, p + k) in ok for k in range(size))]
    return len(kept), all(item[j + k, 1] == doc[p + k, 1] for j, p in kept for k in range(size))


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Most (place in the item, place in the text) in which both grow."""
    tails, ends, before = [], [], {}
    for j, p in sorted(pairs, key=lambda x: (x[1], -x[0])):
        k = bisect_left(tails, j)
        before[j, p] = ends[k - 1] if k else None
        tails[k:k + 1], ends[k:k + 1] = [j], [(j, p)]
    out, at = [], ends[-1] if ends else None
    while at is not None:
        out.append(at)
        at = before[at]
    return out[::-1]


def _alike(words: np.ndarray, ids: np.ndarray, size: int, shift: int) -> list[tuple[int, int]]:
    """All windows of the item ``words`` that the text has at this shift, also those too poor to be looked up."""
    a, b = max(0, -shift), min(len(words), len(ids) - shift)
    if b - a < size:
        return []
    same = (words[a:b] == ids[a + shift:b + shift]).any(axis=1)
    sums = np.concatenate(([0], np.cumsum(same)))
    return [(j, j + shift) for j in (np.flatnonzero(sums[size:] - sums[:-size] == size) + a).tolist()]


def _best_alignment(words: np.ndarray, ids: np.ndarray, size: int, n: int, rich: int, shifts: dict[int, set[int]], share: float) -> tuple[int, int, bool] | None:
    """(windows kept, start, nothing replaced) of the best alignment with ``share`` of all ``n`` windows."""
    least, poor, best = share * n, n - rich, None
    if len(set().union(*shifts.values())) + poor < least:
        return None
    found = {s: _alike(words, ids, size, s) for s in sorted(shifts)}

    def judge(at):
        nonlocal best
        if len(at) >= least and (best is None or len(at) > best[0]):
            kept, same = _consistent(words, ids, at, size)
            start = at[0][1] - at[0][0]
            if kept >= least and (best is None or (kept, -start) > (best[0], -best[1])):
                best = kept, start, same

    for at in found.values():
        judge(at)
    if len(found) > 1 and (best is None or best[0] < n):
        # Chains over neighbouring shifts: bands that overlap by half hold all drifts up to the item's length.
        step, bands = max(8, len(words)), defaultdict(list)
        for s in found:
            bands[s // step].append(s)
            bands[s // step - 1].append(s)
        for band in bands.values():
            if len(band) > 1 and len({j for s in band for j, _ in found[s]}) >= least:
                judge(_chain([x for s in band for x in found[s]]))
    return best


def find_leaks(ids: np.ndarray, index: Index, share: float = SHARE) -> list[tuple]:
    """(item, start, windows kept, windows of the item, word for word) for every leak in the words ``ids``."""
    leaks = {}
    for o, shifts in index.copies.hits(ids[:, 1] ^ _COPY).items():
        item, n = index.items[o][0], index.items[o][4]
        places, shift = max((len(places), -shift) for shift, places in shifts.items())
        if places >= share * n:
            leaks[o] = (item, -shift, places, n, True)
    like, first = collapse(ids)
    for o, shifts in index.likes.hits(like[:, 0]).items():
        if o in leaks and leaks[o][2] == leaks[o][3]:
            continue  # a whole copy
        item, words, size, n, _ = index.items[o]
        if (best := _best_alignment(words, like, size, n, index.rich[o], shifts, share)):
            kept, start, same = best
            leaks[o] = (item, int(first[min(max(start, 0), len(first) - 1)]), kept, n, same)
    return [leaks[o] for o in sorted(leaks)]


_EDGES, _UPPER, _LOWER, _PYTHON = 1, 2, 4, 8  # classes of bytes; 0 is white space, 16 any other
_CLASS = np.full(256, 16, np.uint8)
_CLASS[[b for b in range(128) if chr(b) in _EDGE]] = _EDGES
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _PYTHON, _PYTHON
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0


class Screen:
    """Finds the texts that share enough windows with an item to be aligned with it, many texts at once.

    Words of ASCII without digits are told by hashes of their bytes, all others by ``Templates``. Their ids are those of
    ``Templates``, but values that no item has may be ``OTHER``.
    """

    def __init__(self, common: frozenset[str], known: frozenset[str]):
        self.template, self.hasher = Templates(common, known), Hasher()
        words = [w for w in known | common | UNITS if w and not (_CLASS[list(w.encode())] & _PYTHON).any()]
        value = np.array([_hash(w) if w in known else OTHER for w in words], np.uint64)
        plain = np.where([w in UNITS for w in words], np.uint64(UNIT), value)
        name = np.where([w in UNITS or w in common for w in words], plain, np.uint64(NAME))
        hashes = np.concatenate([self._hashes(words[i:i + 10_000]) for i in range(0, len(words), 10_000)])
        order = np.argsort(hashes)
        self.hashes, self.value, self.plain, self.name = hashes[order], value[order], plain[order], name[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def _hashes(self, words: list[str]) -> np.ndarray:
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size + 1) - 1
        return self.hasher.spans(np.frombuffer(" ".join(words).encode(), np.uint8), ends - size, ends)

    def words(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """(template ids, value ids, numbers, places in ``data``) of its words but punctuation alone, and how many words it has.

        A word also ends at each of ``cuts``.
        """
        kind = np.append(_CLASS[data], np.uint8(0))
        inside = kind[:-1] != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = cuts[cuts < len(data)]
        first[cuts] = inside[cuts]
        begin = np.flatnonzero(first)
        core = np.flatnonzero(kind > _EDGES)
        at = np.searchsorted(core, begin)
        stop = np.append(at[1:], len(core))
        number = np.flatnonzero(stop > at)
        if not len(number):
            none = np.zeros(0, np.uint64)
            return none, none, number, number, len(begin)
        start, end = core[at[number]], core[stop[number] - 1] + 1
        rest = np.bitwise_or.reduceat(kind, np.stack((start + 1, end), 1).ravel())[::2]
        rest[end - start == 1] = 0
        name = (kind[start] == _UPPER) & (rest & (_UPPER | _LOWER) == _LOWER)
        h = self.hasher.spans(data, start, end)
        template, value = np.where(name, np.uint64(NAME), OTHER), np.full(len(h), OTHER, np.uint64)
        few = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        place = np.searchsorted(self.hashes, h[few])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == h[few]
        few, place = few[same], place[same]
        value[few], template[few] = self.value[place], np.where(name[few], self.name[place], self.plain[place])
        slow = np.flatnonzero((kind[start] | rest) & _PYTHON)
        if len(slow):
            raw = data.tobytes()
            ids = self.template([raw[a:b] for a, b in zip(start[slow].tolist(), end[slow].tolist())])
            template[slow], value[slow] = ids[:, 0], ids[:, 1]
            if not template[slow].all():
                kept = np.flatnonzero(template)
                return template[kept], value[kept], number[kept], start[kept], len(begin)
        return template, value, number, start, len(begin)

    def _sharing(self, template: np.ndarray, value: np.ndarray, text: np.ndarray, slices: list[Index]) -> Iterator[tuple[int, np.ndarray]]:
        """(slice, the numbers in ``text`` of texts that share enough with an item of it), from the ids of words of these texts in order."""
        place = np.arange(len(text)) + text  # with an OTHER between two texts
        kinds, values = np.full((2, int(place[-1]) + 1 if len(text) else 0), OTHER, np.uint64)
        kinds[place], values[place] = template, value
        of = np.zeros(len(kinds), np.int64)
        of[place] = text
        kinds, first = collapsed(kinds)
        for s, index in enumerate(slices):
            yield s, np.union1d(index.copies.texts(values ^ _COPY, OTHER ^ _COPY, of), index.likes.texts(kinds, OTHER, of[first]))

    def sharing(self, column: pa.Array, slices: list[Index], reach: int) -> set[tuple[int, int]]:
        """(row, slice) of all texts that share enough windows with an item of the slice for a leak; null is an empty text."""
        found = set()
        data, offsets = texts_of(column)
        row, n = 0, len(offsets) - 1
        while row < n:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _GROUP, "right")) - 1)
            lo, hi = int(offsets[row]), int(offsets[end])
            if hi - lo <= _GROUP:
                cuts = offsets[row:end + 1] - lo
                template, value, _, start, _ = self.words(data[lo:hi], cuts[:-1])
                for s, texts in self._sharing(template, value, np.searchsorted(cuts, start, "right") - 1, slices):
                    found.update((row + i, s) for i in texts.tolist())
            else:  # one long text: its words, then the pieces that are aligned
                parts, total = [], 0
                for a, b in pieces(data, lo, hi, self.hasher.space):
                    template, value, number, _, size = self.words(data[a:b], np.zeros(1, np.int64))
                    parts.append((template, value, number + total))
                    total += size
                template, value, number = (np.concatenate(x) for x in zip(*parts, strict=True))
                for at in range(0, total, _PIECE):
                    a, b = np.searchsorted(number, (at, at + _PIECE + reach))
                    for s, texts in self._sharing(template[a:b], value[a:b], np.zeros(b - a, np.int64), slices):
                        found.update((row, s) for _ in texts)
            row = end
        return found


def leaks_in(text: str, template: Templates, index: Index, reach: int) -> list[tuple]:
    """``find_leaks`` of a whole text, in pieces that overlap by ``reach`` words; of an item in several pieces the fullest."""
    words, best = text.encode().split(), {}
    for at in range(0, len(words), _PIECE):
        ids = template(words[at:at + _PIECE + reach])
        kept = np.flatnonzero(ids[:, 0] != 0)
        for item, shift, n, of, same in find_leaks(ids[kept], index):
            start = at + int(kept[min(max(shift, 0), len(kept) - 1)])
            if item not in best or n > best[item][2]:
                best[item] = (item, start, n, of, same)
    return list(best.values())


_LEAKS = "array<struct<item_id: long, start: long, kept: int, windows: int, verbatim: boolean>>"
_FIELDS = {"item_id": pa.int64(), "start": pa.int64(), "kept": pa.int32(), "windows": pa.int32(), "verbatim": pa.bool_()}


def _leaks_of(sent: list[Broadcast], sent_screen: Broadcast) -> Column:
    @F.arrow_udf(_LEAKS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slices, screen = [received(s) for s in sent], received(sent_screen)
        reach = 8 * max(s.longest for s in slices)
        for texts in batches:
            out = [[] for _ in range(len(texts))]
            for row, s in sorted(screen.sharing(texts, slices, reach)):
                for x in leaks_in(texts[row].as_py(), screen.template, slices[s], reach):
                    out[row].append(dict(zip(_FIELDS, x, strict=True)))
            yield pa.array(out, pa.list_(pa.struct(list(_FIELDS.items()))))

    return leaks.asNondeterministic()(F.col("text"))  # else the planner may run it twice: in a filter and for its value


def with_leaks(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``leaks``: item_id, start (word), kept, windows and verbatim for each item leaked into ``text``."""
    items = benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    rows = lambda i: [tuple(r) for r in items.where(part == i).sort("item_id", "text").collect()]
    if slices == 1:
        rows = cache(rows)
    # Names are told from words by the whole benchmark, so the number of slices changes no result.
    common, known = frozenset(), frozenset()
    for i in range(slices):
        texts = [text for _, text in rows(i)]
        common, known = common | lower_words(texts), known | item_words(texts)
    spark = docs.sparkSession
    found = _leaks_of([send(spark, Index(rows(i), common)) for i in range(slices)], send(spark, Screen(common, known)))
    packed = pack(docs, "text").withColumn("leaks", found)
    return unpack(packed, docs.columns, ["text"], ["leaks"])


def leaked_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item leaked into it."""
    return with_leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.inline("leaks"))
