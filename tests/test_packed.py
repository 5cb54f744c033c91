import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from stemma.operators import packed


@pytest.mark.parametrize(
    "value, items, flag",
    [
        (None, [], ""), ("", [], ""), ("  ;; , ", [], ""),
        ("to hunt", ["to hunt"], ""),
        ("to ask around;to sell forth", ["to ask around", "to sell forth"], ""),
        ("tin and/or lead / hound", ["tin and/or lead", "hound"], ""),
        ("1) wet hare; 2) to look across", ["wet hare", "to look across"], ""),
        ("1. light 2. hard (of a field, rain) 3. humble", ["light", "hard (of a field, rain)", "humble"], ""),
        ('"the ""empty"" sparrow, king"; neck', ['the "empty" sparrow, king', "neck"], ""),
        ("“to fly; of a tin” · pale", ["to fly; of a tin", "pale"], ""),
        ("deaf\n«hard needle; as a dough»\tx", ["deaf", "hard needle; as a dough", "x"], ""),
        ("cut,\xa0clay ,bread;", ["cut", "clay", "bread"], ""),
        ("a, b (c, d", ["a", "b (c, d"], "open_bracket"),
        ('a; "b, c', ["a", '"b, c'], "open_quote"),
        ("((a, b); c) | d", ["((a, b); c)", "d"], ""),
        ("a, “b, c\", d", ["a", "b, c", "d"], "mixed_quote"), ('"b; c”; d', ["b; c", "d"], "mixed_quote"), ("«x, y\" / z", ["x, y", "z"], "mixed_quote"),
        ('a " b, c', ['a " b', "c"], "stray_quote"), ("a; “, b", ["a", "“", "b"], "stray_quote"), ('a, "b, c, d', ["a", '"b, c, d'], "open_quote"),
        ('a (b, "c, d), e', ["a (b, \"c, d)", "e"], ""), ('"a, b" x, "c', ['"a, b" x', '"c'], "open_quote"),
        ("don't, 'x, y'", ["don't", "'x", "y'"], ""),
    ],
)
def test_grammar(value, items, flag):
    assert packed.parse(value) == (items, flag)


@given(st.text(alphabet="ab ;,|()\"“”/1.\n", max_size=60))
def test_no_letter_is_lost(s):
    items, _ = packed.parse(s)
    assert all(i == i.strip() and i for i in items)
    assert sum(i.count("a") + i.count("b") for i in items) == s.count("a") + s.count("b")


def test_long_value():
    assert len(packed.parse("x; " * 200_000)[0]) == 200_000
    assert packed.parse("(" * 50_000)[1] == "open_bracket"
    began = time.time()
    assert packed.parse("(" + ' "a' * 100_001 + ")")[1] == "" and packed.parse(' " ' * 100_001)[1] in ("", "stray_quote")
    assert packed.parse("(" + " “a" * 200_000)[1] == "open_bracket" and packed.parse("“ x " * 100_000)[1] == "stray_quote"
    assert time.time() - began < 10


def test_rows(spark):
    df = spark.createDataFrame([(1, "a; b", "i"), (2, None, "j"), (3, "one", "k"), (4, '"x; y"', None)], "id int, v string, item string")
    got = [tuple(r) for r in packed.split_packed(df, "v", ["id"]).orderBy("id", "item_pos").collect()]
    assert got == [(1, 1, "a", ""), (1, 2, "b", ""), (3, 1, "one", ""), (4, 1, "x; y", "")]
    assert packed.split_packed(df, "v", ["id"], 2).count() == 2
    assert packed.split_packed(df.limit(0), "v", ["id"]).count() == 0


def test_hint_takes_every_blank_of_the_grammar(spark):
    blanks = [c for c in map(chr, range(0x3100)) if c.isspace()]
    values = [f"a{b}/{b}b" for b in blanks] + [f"1.{b}x{b}2.{b}y" for b in blanks] + ["1. x ٢. y"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    want = {(i, p, x) for i, v in enumerate(values) if len(packed.parse(v)[0]) >= 2 for p, x in enumerate(packed.parse(v)[0], 1)}
    assert len(want) >= 2 * len(values) - 8
    assert {(r.id, r.item_pos, r.item) for r in packed.split_packed(df, "v", ["id"], 2).collect()} == want
