import random
import unicodedata as ud

from stemma.llm import charnorm as C

DDL = "id int, v string, lang string, alphabet string, standard string"


def run(spark, pairs):
    df = spark.createDataFrame([(i, v, lang, "own", "clash") for i, (v, lang) in enumerate(pairs)], DDL)
    got = C.standardize(df, "v", "lang", "out")
    assert got.columns == [*df.columns, "out"]
    return [r.out for r in got.orderBy("id").collect()]


def test_cases(spark):
    pairs = [
        (None, "ON"), ("", "ON"), ("  ", None), ("hestr", "ON"), ("ѕνӕrðr", None), ("ｂrúｉ", "ON"), ("f​​lua", "OE"),
        ("θη-рπά‍ις", "Gk."), ("γώσεω1 ", None), ("ｓｖоzъьti", "OCS"), ("kʰa", "Skt."), ("ﬂa‐b c ", "Lat."), ("ουv", "Gk."), ("ov", "Lat."),
        ("ṣ́", "Skt."), ("ṣ́", "Skt."), ("r̥̄x", "Skt."), ("​", "ON"), ("ά", "Gk."),
    ]
    want = [
        None, "", "", "hestr", "sværðr", "brúi", "flua", "θη-ρπάις", "γώσεω1", "svozъьti", "kʰa", "fla-b c", "ουν", "ov",
        "ṣ́", "ṣ́", "r̥̄x", "", "ά",
    ]
    assert run(spark, pairs) == want


def test_agrees_with_canonical_composition(spark):
    rnd = random.Random(4)
    letters = "aeiounsrlāšṛḷáýěǫ" + "̣̥́̄̌̈"
    values = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(200)]
    assert run(spark, [(v, "Lat.") for v in values]) == [ud.normalize("NFC", v) for v in values]


def test_long_and_empty(spark):
    assert run(spark, [("ａ" * 20_000, "Lat.")]) == ["a" * 20_000]
    assert C.standardize(spark.createDataFrame([], DDL), "v", "lang").count() == 0


def test_all_planes_and_public_confusables(spark):
    pairs = [
        ("a\U000e0100b᠏c", "Lat."), ("a b ", "Lat."), ("\U0001d41a\U0001d41b", "Lat."), ("ｶﾞ", None), ("ſanta", "Lat."), ("x\u0007y\x85z", "Lat."),
        ("Ⲟe", "Lat."), ("ꓒx", "Lat."), ("\U000104bb", "Lat."), ("a؀", None), ("ьъ", "OCS"), ("\U0001d6fcβγδ", "Gk."), ("Ԛаԛ", "Lat."), ("日本", None),
    ]
    assert run(spark, pairs) == ["abc", "a b", "ab", "ガ", "santa", "xy z", "Oe", "dx", "\U000104bb", "a؀", "ьъ", "αβγδ", "Qaq", "日本"]


def test_confusables_are_of_one_letter_each(spark):
    got = C.confusables(spark)
    assert got["latin"]["а"] == "a" and got["latin"]["Ѕ"] == "S" and len(got["latin"]) > 100 and len(got["greek"]) > 30
    assert all(a != b and len(b) == 1 and a.isupper() == b.isupper() for t in got.values() for a, b in t.items())
    assert not set(C.KEPT) & set(got["latin"]) and all(b.isascii() for b in got["latin"].values())


def test_frequent_value(spark, monkeypatch):
    monkeypatch.setattr("stemma.session.HOT", 50)
    rows = [("ａb", "Lat.")] * 500 + [("ｘ", "Lat.")] * 3 + [(None, None)] * 20
    assert run(spark, rows) == ["ab"] * 500 + ["x"] * 3 + [None] * 20
