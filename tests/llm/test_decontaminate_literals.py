"""Items of figures, names and capitalised words."""

import pytest

from .test_text_operators import FILL, leaks_in

POOR = ["Calculate 17 * 24 + 9", "Otto Anna Paul Maria Peter", "12 99 17 4 3 8", "Big Storm Hits Northern Coast Towns", "Berlin 3 km"]


@pytest.mark.parametrize("before", ["", "Emil ", "40 "])
def test_whole_copies_of_any_item_are_found(spark, before):
    texts = [f"{FILL} {before}{x} {FILL}" for x in POOR]
    assert leaks_in(spark, texts, POOR) == [(k, k, True) for k in range(len(POOR))]


def test_other_figures_and_names_alone_are_no_copy(spark):
    texts = ["Calculate 18 * 25 + 7", "Emil Ute Karl Lea Eva", "13 98 16 5 2 9"]
    assert leaks_in(spark, [f"{FILL} {x} {FILL}" for x in texts], POOR) == []


def test_the_whole_item_decides(spark):
    """One usable window is no leak if the rest differs; with consistent new values all of it counts."""
    item = "7 8 9 10 we all go to town 7 8 9 10 11 12 13 14 15"
    new = item
    for k in range(15, 6, -1):
        new = new.replace(f" {k}" if k > 7 else "7", f" {k + 100}" if k > 7 else "107")
    texts = ["one day we all go to town and then home", f"{FILL} {new} {FILL}", item]
    assert leaks_in(spark, texts, [item]) == [(1, 0, False), (2, 0, True)]
