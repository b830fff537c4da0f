"""Windows looked up in the bytes of many texts at once find what a look at every text, word by word, finds."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quartermart.llm import decontaminate as D, shingles

ITEMS = ["Anna buys 12 apples for 3 dollars and gives Peter 5 of the apples before she walks 2 km home",
         "«Élan» don't stop at O'Neil street, e.g. the 1,000 m² of 5km roads — naïve K-means by İpek (2nd)",
         "Tom Tom Lee Ann Ray Sue Kim Lea", "17 * 24 + 9 / 3 - 2", "the quick fox", "word", "... !!! ,,,", None, "",
         "日本 語 の テキスト を 読む 人 は 多い です ね", "ALL CAPS And Mixed mIxed cases of Words in the Street of O'Neil"]
EDGES = ["", "", "", "", ",", "(", '"', "«", "”", "...", "’", "—", "?!", "\x1c", "\x00", "é"]
WORDS = ["Maria", "Otto", "km", "KM", "Km", "97", "8.50", "$3", "5kg", "5KG", "10%", "+", "*", "don.t", "o'neil", "ONEIL", "apple", "K-means", "K-means", "x", "X",
         "Zoë", "ZOË", "İpek", "ipek", "i̇pek", "ß", "SS", "２km", "٣", "1e5", "12:30", "A1b", "𝐀bc", "Ǆar", "ǅar", "’", "zz zz", "a" * 300, "Q" + "q" * 300]


def plain(texts, items, index_of, common):
    """(text, item, start, kept, windows, verbatim), from every word of every text."""
    template, out = D.Templates(common), []
    reach = 8 * max(s.longest for s in index_of)
    for row, text in enumerate(texts):
        for index in index_of:
            out += [(row, *x) for x in (D.leaks_in(text, template, index, reach) if text else [])]
    return out


def screened(texts, screen, index_of):
    reach, out = 8 * max(s.longest for s in index_of), []
    for row, s in sorted(screen.sharing(pa.array(texts, pa.string()), index_of, reach)):
        out += [(row, *x) for x in D.leaks_in(texts[row], screen.template, index_of[s], reach)]
    return out


@pytest.mark.parametrize("piece, group, seed, hits", [(400_000, 1 << 18, 1, 1 << 21), (400_000, 1 << 18, 2, 0), (40, 200, 3, 1 << 21),
                                                      (15, 1, 4, 50), (400_000, 1, 5, 1 << 21)])
def test_the_screen_misses_no_leak(monkeypatch, piece, group, seed, hits):
    monkeypatch.setattr(D, "_HITS", hits)
    monkeypatch.setattr(D, "_PIECE", piece)
    monkeypatch.setattr(D, "_GROUP", group)
    monkeypatch.setattr(shingles, "_PIECE", max(group, 64))
    r = random.Random(seed)
    vocabulary = [w for t in ITEMS if t for w in t.split()] + WORDS

    def word(w):
        w = r.choice([w, w, w, w.upper(), w.lower(), w.title()])
        return r.choice(EDGES) + w + r.choice(EDGES)

    def text():
        out = []
        for _ in range(r.randint(0, 6)):
            if r.random() < .6:
                own = (r.choice(ITEMS) or "").split()
                out += [word(r.choice(vocabulary)) if r.random() < .04 else word(w) if r.random() < .15 else w for w in own if r.random() > .01]
            else:
                out += [word(r.choice(vocabulary)) for _ in range(r.randint(0, 12))]
        return "".join(w + r.choice([" ", " ", "\n", "\t\x0b "]) for w in out)[: r.choice([-1, None])]

    texts = [r.choice([text(), text(), text(), None, ""]) for _ in range(400)]
    items = list(enumerate(ITEMS))
    common, known = D.lower_words(ITEMS), D.item_words(ITEMS)
    for slices in (1, 3):
        index_of = [D.Index(items[i::slices], common) for i in range(slices)]
        want = plain(texts, ITEMS, index_of, common)
        assert len(want) > 150 and screened(texts, D.Screen(common, known), index_of) == want


def test_ids_of_the_screen_are_those_of_the_templates():
    common, known = D.lower_words(ITEMS), D.item_words(ITEMS)
    words = [a + w + b for w in [w for t in ITEMS if t for w in t.split()] + WORDS for w in (w, w.upper(), w.lower()) for a in EDGES for b in EDGES]
    words = [x for w in words for x in w.encode().split()]
    want = D.Templates(common, known)(words)
    kept = np.flatnonzero(want[:, 0])
    data = np.frombuffer(b" ".join(words), np.uint8)
    template, value, number, start, n = D.Screen(common, known).words(data, np.zeros(1, np.int64))
    assert n == len(words) and (number == kept).all() and (template == want[kept, 0]).all()
    items = D.Templates(common)([w for t in ITEMS if t for w in t.encode().split()])[:, 1]
    told = np.isin(want[kept, 1], items)
    assert told.any() and (value[told] == want[kept, 1][told]).all() and not np.isin(value[~told], items).any()


def test_plain_words_are_not_looked_at_one_by_one():
    """Thousands of new words of ASCII that no item has go through no Python code; before, each took a dozen calls."""
    text = " ".join(f"{a}{b}{c}{d}" for a in "bcdfg" for b in "aeiou" for c in "klmnp" for d in ("", "er", "ing", "s", "Ed", "is,"))
    common, known = D.lower_words(ITEMS), D.item_words(ITEMS)
    screen = D.Screen(common, known)
    assert screen.sharing(pa.array([text] * 3, pa.large_string()), [D.Index(list(enumerate(ITEMS)), common)], 100) == set()
    assert len(screen.template) == 0


def test_a_common_phrase_is_no_reason_to_align():
    items = [(i, f"before she walks 2 km home w{i} {ITEMS[0]} x{i}") for i in range(20)]
    common, known = D.lower_words(t for _, t in items), D.item_words(t for _, t in items)
    phrase, whole = "we all say: before she walks 2 km home, and so on.", f"as said, {items[3][1].replace('Anna', 'Maria')} indeed"
    assert D.Screen(common, known).sharing(pa.array([phrase, whole, f"{phrase} {phrase}"]), [D.Index(items, common)], 800) == {(1, 0)}
