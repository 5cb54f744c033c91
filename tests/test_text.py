from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.functions import translit as X


def one(spark, expr, *values, ddl="v string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], ddl).select(expr).collect()]


def test_keys_and_words(spark):
    assert one(spark, T.fold_key(F.col("v")), "Ünnǣ ", "χῶρος", None) == ["unnæ", "χωρος", None]
    assert one(spark, T.match_key(F.col("v")), "(vir-)ī*us2 x", "", None) == ["uirīus", None, None]
    assert one(spark, T.first_word(F.col("v")), "ā-mo", "--", None) == ["ā", None, None]
    assert one(spark, T.before(F.col("v"), " ("), "abc (d)", "abc", None) == ["abc", "", None]


def test_cleaning(spark):
    assert one(spark, T.punctuation_spacing(F.col("v")), "a ,b ( c )  d", None) == ["a, b (c) d", None]
    assert one(spark, T.balanced(F.col("v")), " (a, ", "a) b]", "", None) == ["(a)", "[(a) b]", "", None]
    assert one(spark, T.homonym(F.col("v"))[1], "vir2", "vir", "", None) == [2, None, None, None]
    assert one(spark, T.repair_mojibake(F.col("v")), "sÃ¼d", "ā", "Ã", "süd", None) == ["süd", "ā", "Ã", "süd", None]
    assert one(spark, T.abbreviation_tokens(T.abbreviation(F.col("v"))), ' "ai.-gr." ', "ai. gr.; ai.", "", None) == [["ai.", "gr."], ["ai.", "gr."], [], None]
    assert one(spark, T.is_blank(F.col("v")), None, " ", "NaN", "x") == [True, True, True, False]
    assert one(spark, T.shortened(F.col("v"), 3), "abcd", "abc", None) == ["abc …", "abc", None]
    assert one(spark, T.unescape("v"), "a &amp; &y-acute; &nix; &eacute;", None) == ["a &amp; y\u0301 &nix; é", None]
    assert one(spark, T.nfc("v"), "e\u0301", None) == ["é", None]
    assert one(spark, T.slug(F.col("v")), "Þórr inn æðri", None) == ["thorr-inn-aedri", None]
    assert one(spark, T.lower_tags(F.col("v")), "<B>x</B>") == ["<b>x</b>"]


def test_locations(spark):
    df = spark.createDataFrame([("<a. w. 1.2.3> t",), ("<a. w. 1.2> t",), ("<a. w. 7> t",), ("none",)], "v string")
    assert [tuple(r) for r in df.select(*T.location(F.col("v"))).collect()] == [("1", "2", "3"), ("1", None, "2"), (None, None, "7"), (None, None, None)]
    assert one(spark, T.line_mark(F.col("v")), "<a. w. 1.2> t x") == ["t x"]
    assert [tuple(r) for r in spark.createDataFrame([("/x/vergil.aeneid.tess",)], "v string").select(*T.file_parts(F.col("v"))).collect()] == [("vergil", "aeneid")]


def test_transliteration():
    assert X.slp1_to_iast("agnIzomA") == "agnīṣomā" and X.slp1_to_deva("agnIzomA") == "अग्नीषोमा"
    assert X.slp1_to_iast("a/MSa") == "aṃśa".replace("a", "a\u0301", 1)
    for form in ("kfzRa", "DArmika", "Jawa", "ESvarya", "OzaDa", "duHKa", "agni/", "ma^nu"):
        assert X.iast_to_slp1(X.slp1_to_iast(form)) == form
    assert X.iast_to_deva("kṛṣṇa") == X.slp1_to_deva("kfzRa") == "कृष्ण"
    assert X.slp1_to_deva("vAk") == "वाक्" and X.slp1_to_deva("") == ""
    assert X.restore_capitals("āsa-bhaga") == "Asa-Baga"
    assert X.accent_of("a/MSa") == ("aMSa", 1) and X.accent_of("deva") == ("deva", None)
    assert X.with_accent("deva/") == ("devá", "देव॑")
    assert X.spell_marked("x <s>deva</s> y") == "x deva (देव) y"
    assert X.greek_to_roman("Ἀχιλλεύς ῥόδον ἄγγελος") == "Akhilleus rhodon angelos"
    assert X.repair_gloss("a.b deva", ["a.b"]).startswith("a.b (")


def test_symbols(spark):
    df = spark.createDataFrame([("k", "acute"), ("gʷ", "aspiration"), ("xgʷ", "aspiration"), ("p", "aspiration"), ("y", "macron"), ("h", "sub2"), ("", "acute"), (None, "acute"), ("q", "nix")], "l string, m string")
    assert [r[0] for r in df.select(X.modify("l", "m")).collect()] == ["ḱ", "gʷʰ", "xgʷʰ", "pʰ", "y\u0304", "h₂", "", None, "q"]
    assert one(spark, X.target_symbol(F.col("v")), "agʷ", "ab", "", None) == ["gʷ", "b", None, None]
    fam = spark.createDataFrame([(1, "a1", ["á", "à"]), (2, "a2", ["à", "ā"]), (1, "k", ["ḱ"])], "lang int, b string, v array<string>")
    assert {r.base: r.variants for r in X.merged_families(fam, "b", "v", ["lang"]).collect()} == {"a": ["á", "à", "ā"], "k": ["ḱ"]}
