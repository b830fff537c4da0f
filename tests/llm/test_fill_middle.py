"""Fill-in-the-middle: cuts against plain slicing, exact round trips, odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermart.llm import fill_middle as M


@pytest.mark.parametrize("size", [1, 2, 3, 50, 4000])
def test_seek_equals_the_sum_of_widths(size):
    rng = random.Random(size)
    text = "".join(rng.choice("ab Zé\n<😀_9") for _ in range(size))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    starts = M.unit_starts(text)
    assert [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)] == units
    found = M.UnitList(np.diff(starts, append=len(text)))
    for r in range(len(units) + 1):
        assert found.seek(r) == len("".join(units[:r]))


def test_lanes_carry_both_widths_and_thin_out():
    widths = np.arange(1, 20_001)
    lanes = M.UnitList(widths).lanes
    assert all(sum(units) == len(widths) and sum(points) == widths.sum() for units, points, _ in lanes)
    assert all(len(b[0]) < 0.5 * len(a[0]) for a, b in zip(lanes[:4], lanes[1:5], strict=True)) and len(lanes[-1][0]) < 8


def test_every_form_round_trips_and_parts_add_up():
    rng, forms = random.Random(5), set()
    for i in range(600):
        text = "".join(rng.choice(["word", " ", "<", "P>", "<S", ">", "é", "😀", "\n"]) for _ in range(rng.randrange(30)))
        draws = M.draw(i)
        n, form, prefix, middle, output = M.fill_middle(text, draws)
        forms.add(form)
        assert M.restore(output, form) == text and n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text))
        held = any(s in text for s in ("<P>", "<S>", "<M>"))
        assert (form == M.PLAIN) == (not text or held or draws[2] % 100 >= 90)
        if form != M.PLAIN:
            a, b, c = text[:prefix], text[prefix:prefix + middle], text[prefix + middle:]
            assert output == (f"<P>{a}<S>{c}<M>{b}" if form == M.PSM else f"<S>{c}<P>{a}<M>{b}")
    assert forms == {M.PLAIN, M.PSM, M.SPM}


def test_draw_is_the_sha_of_seed_and_id():
    h = hashlib.sha256(b"1:42").hexdigest()
    assert M.draw(42) == tuple(int(h[k:k + 8], 16) for k in (0, 8, 16, 24))


def test_odd_rows_clashing_names_and_empty_table(spark, odd, none):
    odd = odd.withColumns({"form": F.lit(1), "output": F.lit("x"), "_made": F.lit(2)})
    got = M.to_fill_middle(odd).withColumn("back", M.restored(F.col("output"), F.col("form")))
    assert got.columns == [c for c in odd.columns if c not in M.OWN] + M.OWN + ["back"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.back == (r.text or "") for r in rows)
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == M.fill_middle(r.text or "", M.draw(r.doc_id))
    assert M.to_fill_middle(none).collect() == []


def test_ids_above_2_to_53_next_to_null(spark):
    rows = [(2**60 + 1, "some words here"), (None, "some words here"), (2**60 + 3, "some words here")]
    got = {r.doc_id: r for r in M.to_fill_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert tuple(got[i])[2:] == M.fill_middle(t, M.draw(i))
