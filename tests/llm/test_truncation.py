import random

from stemma.llm import truncation as T

FIELDS = {"gloss": T.Field(ref="item"), "note": T.Field(prose=True)}


def test_compare():
    assert T.compare("a, bc", "x, vb. a; bc; d", "item") == "whole" and T.compare("a, b", "x, vb. a; bc; d", "item") == "more"
    assert T.compare("a, q", "x, vb. a; bc", "item") == "none" and T.compare("a", None, "item") == "none"
    assert T.compare("ab", "ab, cd", "prefix") == "whole" and T.compare("ab, c", "ab, cd", "prefix") == "more" and T.compare("ab, ", "ab, cd", "prefix") == "more"
    assert T.compare("ab", "ab = cd", "prefix") == "whole" and T.compare("x", "ab", "prefix") == "none"
    assert len(T.last_item("a; " * 300_000)) == 4 and T.last_item("(x; " * 100_000)[:1] == "("
    assert T.last_item("a; b (c; d") == " b (c; d" and T.last_item("") == "" and T.last_item("a;") == "a;"


def test_learns_cuts(spark):
    rnd = random.Random(2)
    nouns = "horse bridge anchor ploughman thunder meadow shepherd chisel barley candle feather hammer".split()
    verbs = "borrow measure whisper strike gather follow linger darken polish wander".split()
    rows, cut = [], set()
    for i in range(900):
        items = [f"to {rnd.choice(verbs)} the {rnd.choice(nouns)}" if rnd.random() < 0.5 else f"{rnd.choice(nouns)} of the {rnd.choice(nouns)}" for _ in range(rnd.randint(1, 5))]
        whole = "; ".join(items)
        value = whole[:40] if i % 2 else whole
        if len(value) < len(whole) and not whole[len(value) :].startswith(";") and not value.endswith((";", " ")):
            cut.add(i)
        rows.append(("gloss", "S" if i % 2 else "T", i, value, f"x, vb. {whole}; cf. y" if i % 3 else None, "clash"))
    rows += [("gloss", "S", 5000, None, None, "c"), ("gloss", None, 5001, " ", None, "c"), ("gloss", None, 5002, "horse of the bridge", None, "c")]
    df = spark.createDataFrame(rows, "field string, source_key string, row_id int, value string, ref string, seen string")
    scored, held_out = T.score(df, FIELDS, 6400)
    got = {r.row_id: r.probability for r in scored.collect()}
    assert held_out > 0.85 and 5000 not in got and 5001 not in got and 5002 in got
    found = {i for i, p in got.items() if p > 0.5}
    assert len(found & cut) / len(cut) > 0.9 and len(found & cut) / max(len(found), 1) > 0.85


def test_without_training_rows(spark):
    df = spark.createDataFrame([("gloss", "S", 1, "a (b", None)], "field string, source_key string, row_id int, value string, ref string")
    assert T.score(df, FIELDS)[0].count() == 1
    assert T.score(df.limit(0), FIELDS)[0].count() == 0


def test_limits_below_stragglers(spark):
    rnd = random.Random(3)
    rows = [(s, "x" * rnd.randint(5, 50)) for s in ("bytes", "torn", "chars", None) for _ in range(300)]
    # cut at 60 bytes, with and without longer characters; torn characters are stored as three bytes
    rows += [(s, "y" * (60 - 2 * k) + "é" * k) for s in ("bytes", "torn", None) for k in (0, 1, 2, 3) for _ in range(8)]
    rows += [("torn", "y" * 60 + "�")] * 5 + [("bytes", "z" * 63), ("bytes", "z" * 64)]
    # cut at 60 characters: values of 60 bytes are those without longer characters
    rows += [("chars", "y" * (60 - k) + "é" * k) for k in (0, 0, 0, 0, 0, 0, 0, 1) for _ in range(5)] + [("chars", "z" * 70)]
    df = spark.createDataFrame([("gloss", s, v, None) for s, v in rows], "field string, source_key string, value string, ref string")
    got = {r.source_key: (r.max_chars, r.max_bytes) for r in T.limits(df).collect()}
    assert got["bytes"][1] == 60 and got["torn"][1] == 60 and got[None][1] == 60 and got["chars"] == (60, None)
    ready = T.prepare(df, T.limits(df))
    at = ready.where("distance = 0 and octet_length(value) >= 59").groupBy("source_key").count()
    assert {r.source_key: r["count"] for r in at.collect()} == {"bytes": 32, "torn": 37, None: 32, "chars": 40}
    assert ready.where("length(value) < 50 and distance <> (case when source_key = 'chars' then 60 - length(value) else 60 - octet_length(value) end)").count() == 0
    assert ready.where("value like 'zzz%' and distance <> -1").count() == 0


def test_artificial_cuts_measure_their_limit():
    """Every example's distance is that of its own value to a limit, and torn characters come from cuts in bytes."""
    spec, limits = T.Field(ref="item"), [("chars", 20), ("bytes", 7), ("chars", 90)]
    torn = 0
    for seed in range(300):
        full = ["ætt; þing (við); öld og ár", "horse; bridge of the king; to follow the brow; anchor", "to bear"][seed % 3]
        for v, d, label in T.artificial(full, spec, limits, seed):
            bare = v.rstrip("\ufffd")
            fits = {n - (len(bare) if u == "chars" else len(bare.encode())) for u, n in limits}
            assert d == T.FAR or d in fits or v.strip(" ,;") == full or d <= len(full)
            assert label == 1 or v != bare or v.strip()[-1:].isalnum() or v.rstrip()[-1:] in ");,"
            torn += v.endswith("\ufffd")
            if v.endswith("\ufffd") or v.count("(") > v.count(")"):
                assert label == 1
    assert torn > 0
    assert T.artificial("ab", T.Field(), [], 1)[0] == ("ab", T.FAR, 0)


def test_length_to_limit_is_a_number():
    near = [T.nearness(d) for d in (0, 1, 5, 200, T.FAR)]
    assert near == sorted(near, reverse=True) and near[0] == 1 and near[-1] == 0
    assert [T.step_of(d) for d in (0, 1, 2, 3, 8, 9, 33, 10**9, T.FAR)] == [0, 1, 2, 3, 3, 4, 5, 5, 6]


def test_limit_decides_between_equal_endings(spark):
    """Two sources end in the same words; only the one that piles up at its limit is cut there."""
    rnd = random.Random(8)
    words = "horse bridge anchor ploughman thunder meadow shepherd chisel barley candle feather hammer".split()
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 14)))
    rows = [("note", "limited" if i % 2 else "free", i, (text() + ".")[: 60 if i % 2 else 500], None) for i in range(1600)]
    df = spark.createDataFrame(rows, "field string, source_key string, row_id int, value string, ref string")
    got = {r.row_id: r.probability for r in T.score(df, FIELDS)[0].collect()}
    cut = [r[2] for r in rows if len(r[3]) == 60 and not r[3].endswith(".")]
    whole = [r[2] for r in rows if r[3].endswith(".")]
    assert sum(got[i] > 0.5 for i in cut) > 0.9 * len(cut) and sum(got[i] > 0.5 for i in whole) < 0.03 * len(whole)


def test_word_that_ends_most_values(spark):
    """A frequent last word meets the vocabulary in several tasks or none; results stay whole."""
    rows = [("gloss", "S", i, f"item{i % 7} of the king", None) for i in range(400)] + [("gloss", "S", 1000 + i, "(", None) for i in range(50)]
    df = spark.createDataFrame(rows, "field string, source_key string, row_id int, value string, ref string")
    assert T.score(df, FIELDS)[0].count() == 450
