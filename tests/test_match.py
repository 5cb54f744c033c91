from pyspark.sql import functions as F

from stemma.operators import match, merge, windows
from stemma.operators import transliteration_match as TM


def test_joins(spark):
    a = spark.createDataFrame([(1, "L", "Ábc "), (2, "L", None), (3, "M", "abc")], "id int, lang string, w string")
    b = spark.createDataFrame([("L", "abc", 9), ("L", "ABĆ", 8)], "lang string, lemma string, mid int")
    got = {(r.id, r.mid) for r in match.literal_match(a, b, "w", "lemma", ["lang"]).collect()}
    assert got == {(1, 9), (1, 8)}
    assert {(r.id, r.mid) for r in match.collated_match(a, b, "w", "lemma", "lang", "UNICODE_CI_AI_RTRIM").collect()} == got
    left = spark.createDataFrame([(1, "a,b,c"), (2, "a"), (3, ""), (4, None), (5, "ab")], "id int, l string")
    right = spark.createDataFrame([("a",), ("a,b",), ("b",)], "k string")
    assert {(r.id, r.k) for r in match.equal_or_listed(left, right, "l", "k", []).collect()} == {(1, "a"), (1, "a,b"), (2, "a")}


def test_status_and_decisions(spark):
    rows = [(1, 10, "x  y", "1. x y"), (2, 10, "q", "z"), (3, 11, "q", "z"), (4, 12, "q", "z"), (4, 13, "q", "z"), (5, None, "q", None), (1, 11, "x  y", "z")]
    df = spark.createDataFrame(rows, "p int, m int, a string, b string")
    got = {(r.p, r.m): r.status for r in match.five_way(df, "p", "m", match.exact_entry(F.col("a"), F.col("b"))).collect()}
    assert got == {(1, 10): "exact", (1, 11): "superseded", (2, 10): "repeat", (3, 11): "single", (4, 12): "multiple", (4, 13): "multiple", (5, None): "none"}
    exact = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "p int, m int")
    ok, dup = match.approved_one_to_one(exact, "p", "m")
    assert [r.p for r in ok.collect()] == [3] and {r.p for r in dup.collect()} == {1, 2}
    d = spark.createDataFrame([(4, 13, "approve"), (5, 1, "reject")], "p int, m int, verdict string")
    c = spark.createDataFrame([(4, 12), (4, 13), (5, 1), (6, 2)], "p int, m int")
    assert {(r.p, r.m): r.outcome for r in match.apply_decisions(c, d, "p", "m", "m").collect()} == {(4, 12): "dropped", (4, 13): "approved", (5, 1): "rejected", (6, 2): "remaining"}
    s = spark.createDataFrame([("see *12 x",), ("none",), (None,)], "t string")
    ids = spark.createDataFrame([("*12", 77)], "a string, b int")
    assert [r.t for r in match.substitute_ids(s, "t", ids, "a", "b").collect()] == ["see 77 x", "none", None]


def test_entries(spark):
    good, bad = "devá (देव) god", "de (देव)vA god"
    cases = [
        ("ab  cd", "1. ab cd ef", "approved"), ("1. ab", "1. ab", "approved"), ("a", None, "unmatched"), (None, "a", "unmatched"), ("", "x", "approved"), ("", "", "approved"),
        (good, good + " more", "approved"), ("abcdefghij", "abcdefghiX", "approved"), ("abc", "xyz", "unmatched"), (good, "god", "discrepant"),
        (good, "devā (देवा) god", "approximate"), ("de\u0301va (देव)", "deva (देव)", "approved"),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r for r in df.select("i", TM.routed(F.col("a"), F.col("b")).alias("r")).select("i", "r.*").collect()}
    assert [got[i].route for i in range(len(cases))] == [x for _, _, x in cases]
    assert got[0].score is None and got[2].score is None and round(got[7].score, 4) == 90.0
    assert [bad[p.begin : p.word_end] + "|" + p.slipped for p in TM.pairs_of(bad)] == ["de|vA"]
    assert TM.pairs_of("") == [] and [p.begin for p in TM.pairs_of("no (brackets) here (देव) (देव)")] == [14]
    long = "x " * 20_000 + good
    assert len(TM.pairs_of(long)) == 1


def test_merge(spark):
    t = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (3, 6, "c")], "k int, w int, s string")
    src = spark.createDataFrame([(1, 9), (1, 8), (3, None)], "k int, n int")
    assert {r.k: r.w for r in merge.update_from(t, src, ["k"], {"w": "n"}).collect()} == {1: 8, 2: 5, 3: None}
    assert {r.k: r.w for r in merge.update_from(t, src, ["k"], {"w": "n"}, clear_unmatched=True).collect()} == {1: 8, 2: None, 3: None}
    assert [r.k for r in merge.ambiguous_keys(src, ["k"]).collect()] == [1]
    new = spark.createDataFrame([(7, 1, "b")], "k int, w int, s string")
    assert {r.k for r in merge.slice_overwrite(t, new, "s").collect()} == {1, 3, 7}
    grown, refused = merge.append_new(t, new.union(t.where("k = 1")), ["k"])
    assert grown.count() == 4 and refused.count() == 1


def test_windows(spark, tmp_path):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(["a", "a", "b", "a", None, None], 1)], "seq int, lemma string").withColumn("f", F.lit("x"))
    got = {r.seq: r.sense_num for r in windows.renumber_homonyms(df, ["f"], "seq", "lemma", F.lit(True)).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: None, 5: 1, 6: 2}
    numbered = windows.global_row_number(spark.range(500).withColumn("k", F.col("id") * 7 % 501), [F.col("k")], "n", 10)
    assert [r.n for r in numbered.orderBy("k").collect()] == list(range(11, 511))
    lv = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 1), (5, 2)], "seq int, lv int").withColumn("f", F.lit("x"))
    assert {r.seq: r.p for r in windows.nearest_shallower(lv, ["f"], "seq", F.col("lv"), "seq", 4, "p").collect()} == {1: None, 2: 1, 3: 2, 4: 1, 5: 4}
    ol = spark.createDataFrame([(1, 1, "I"), (2, 2, "A"), (3, 4, "z"), (4, 2, "B")], "seq int, lv int, lb string").withColumn("f", F.lit("x"))
    assert {r.seq: r.o for r in windows.outline_labels(ol, ["f"], "seq", "lv", "lb", "o").collect()} == {1: "I", 2: "I.A", 3: "I.A.X.z", 4: "I.B"}
    merge.write_slices(df.select("seq", "f"), str(tmp_path / "s"), "f")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6
