"""Replacements of another number of words, and how alignments of several shifts are chained."""

from .test_text_operators import FILL, ITEM, leaks_in

LONG = " ".join(f"word{chr(97 + k)}" for k in range(20))
SLOTS = " ".join("Tom" if k % 5 == 2 else f"word{chr(97 + k)}" for k in range(20))


def with_more(text, *extra):
    """``text`` with the words ``extra`` put in after its tenth word."""
    words = text.split()
    return " ".join([*words[:10], *extra, *words[10:]])


def test_slots_of_another_number_of_words(spark):
    other = ITEM.replace("Peter", "Peter Schmidt").replace("2 km", "2km")
    more = ITEM.replace("Anna", "Maria Luise Weber").replace("3 dollars", "8.50eur")
    assert leaks_in(spark, [f"{FILL} {other} {FILL}", more, FILL], [ITEM]) == [(0, 0, False), (1, 0, False)]


def test_shifts_are_chained_in_order(spark):
    words = LONG.split()
    texts = [with_more(LONG, "really"), with_more(LONG, "really", "and", "truly"), " ".join(words[10:] + words[:10]), " ".join(words[:10])]
    assert leaks_in(spark, [f"{FILL} {t} {FILL}" for t in texts], [LONG]) == [(0, 0, True), (1, 0, True)]


def test_slots_must_agree_across_a_chain(spark):
    names = iter(["Jim", "Bob", "Kim", "Lea"])
    mixed = " ".join(next(names) if w == "Tom" else w for w in SLOTS.split())
    texts = [with_more(SLOTS.replace("Tom", "Jim"), "really"), with_more(mixed, "really")]
    assert leaks_in(spark, texts, [SLOTS]) == [(0, 0, False)]
