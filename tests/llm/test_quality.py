import pytest

from stemma.llm import quality as Q

COMMON = frozenset("the of and to a in is that it was for on are as with be by this which not".split())
PROSE = "The word of the older texts is not found in this part of the book, and it was left out by the scribe."


@pytest.mark.parametrize(
    "text, kind",
    [
        (None, "empty"), (" \n ", "empty"), (PROSE, "prose"), ("\n".join(PROSE.split(", ")), "prose"),
        ("\n".join(f"{i}. {PROSE}" for i in range(1, 6)), "prose"),
        (PROSE * 3 + "\n- nail\n- horse\n", "prose"),
        (PROSE + "\n" + "\n".join(f"- {w} horse" for w in "abcdefghijklmnopqrstu") * 2, "list"),
        ("\n".join(f"{i}\tx{i}\tnom.\t{i * 7}" for i in range(20)), "table"),
        ("+----+----+\n" + "\n+----+----+\n".join(f"| {i:3}|f.  |" for i in range(9)), "table"),
        ("\n".join(f"gloss = {i}" for i in range(12)), "table"),
        ("\n".join(["Page not found"] * 30), "junk"),
        (" ".join("T h e  w o r d  i s  o l d".split(" ") * 9), "junk"),
        ("9110a7cc 4791f752 e9ce213c 8f11110f " * 20, "junk"),
        ('<div n="9"><span n="2">x</span></div>' * 30, "junk"),
        ("th# w|rd o¦ th~ b£ok i§ n#t f|und " * 9, "junk"),
    ],
)
def test_kinds(text, kind):
    got = dict(zip(Q.NAMES, Q.measure(text, COMMON)))
    assert got["kind"] == kind
    assert got["n_words"] == 0 if kind == "empty" else True


WORDS = "zelon hleis sufno taens brothos ligra ptousa mero gant wend olda irka nuls tremo".split()


@pytest.mark.parametrize(
    "text, kind",
    [
        ("\n".join(WORDS), "list"), ("\n".join(f"{w}: nail; horse" for w in WORDS), "list"), ("; ".join(f"{w} {i * 37}" for i, w in enumerate(WORDS)), "list"),
        ("\n".join(f"[{'x ' [i % 2]}] see {w} {i}." for i, w in enumerate(WORDS)), "list"), ("\n".join(f"{w} ........ {i}" for i, w in enumerate(WORDS)), "table"),
        ("\n".join(",".join(WORDS[i : i + 4]) for i in range(9)), "table"), (PROSE + "\n" + ", ".join(WORDS * 4), "list"), ("Chapter One\n" + PROSE + "\nThe End", "prose"),
    ],
)
def test_structure_decides(text, kind, monkeypatch):
    """Lists and tables are found by structure: without it their short units are taken for prose or junk."""
    assert dict(zip(Q.NAMES, Q.measure(text, COMMON)))["kind"] == kind
    monkeypatch.setattr(Q, "alignment", lambda marks, words: [0.0] * (len(words) - 1))
    monkeypatch.setattr(Q, "periodicity", lambda units, marked: [0.0] * len(units))
    monkeypatch.setattr(Q, "autocorrelation", lambda lengths: 0.0)
    assert dict(zip(Q.NAMES, Q.measure(text, COMMON)))["kind"] not in ("list", "table")


def test_structure_measures():
    assert Q.alignment([("\t",), ("\t",), ()], [2, 2, 9]) == [1.0, 0.0] and Q.alignment([], []) == [] and Q.alignment([()], [1]) == []
    assert Q.periodicity(["a", "  b", "    c", " d"], [False] * 4) == [0.0, 1.0, 1.0, 0.0]
    assert Q.autocorrelation([5, 5, 5]) == 1.0 and Q.autocorrelation([1, 2]) == 0.0 and Q.autocorrelation([1, 9] * 6) < -0.5


def test_statistics(spark):
    rows = [(1, PROSE, "x"), (2, None, "x"), (3, "", "x"), (4, PROSE, "x"), (5, "a " * 300_000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    words = spark.createDataFrame([("The",), ("of",), (None,)], "word string")
    common = Q.common_words(words)
    assert common == {"the", "of"}
    got = {r.doc_id: r for r in Q.statistics(df, "doc_id", "text", COMMON).collect()}
    assert len(got) == 5 and got[1].n_words == 23 and got[1].kind == got[4].kind == "prose" and got[2].mean_word_len is None
    assert abs(got[1].common_word_ratio - got[4].common_word_ratio) < 1e-12 and got[1].line_end_punct_ratio == 1.0
    assert Q.statistics(df.limit(0), "doc_id", "text", COMMON).count() == 0
