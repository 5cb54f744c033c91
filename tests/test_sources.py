import pytest
from pyspark.sql import functions as F

from stemma.operators import corpus
from stemma.sources import readers, sinks


def test_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('id,word,at\n1,"a ""b"", c\nd",01_31_2024_1730\n,\\N,bad\n2,"\\N",\n', encoding="utf-8")
    df = readers.read_csv(spark, str(p), ["id", "word", "at"])
    t = readers.typed(df, {"id": "int"}, {"at": "MM_dd_yyyy_HHmm"})
    rows = sorted([tuple(r) for r in t.select("id", "word", F.date_format("at", "HH:mm")).collect()], key=str)
    assert rows == sorted([(1, 'a "b", c\nd', "17:30"), (None, None, None), (2, None, None)], key=str)
    assert readers.read_csv(spark, str(p), ["id", "word", "at"], keep=["word"]).columns == ["word"]
    with pytest.raises(ValueError):
        readers.with_constant_from(df, df, "id = '9'", "word", "x")
    assert readers.next_id(t, "id") == 3 and readers.column_catalog(t).count() == 3
    out = str(tmp_path / "o")
    sinks.write_csv(t.drop("at"), out, ["id"], single_file=True)
    assert readers.read_csv(spark, out, ["id", "word"]).count() == 3
    sinks.write_bounded(spark.range(1000).selectExpr("id", "repeat('x', 100) v"), str(tmp_path / "b"), max_bytes=20_000)
    assert len(list((tmp_path / "b").glob("*.csv"))) > 4
    sinks.write_routed(t.drop("at").withColumn("route", F.lit("r")), str(tmp_path / "r"), "route")
    sinks.write_jsonl(t, str(tmp_path / "j"))


def test_other_sources(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("raw\t\t3\tx\n\nonly\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_ragged_tsv(spark, str(tmp_path / "a.tsv")).collect()] == [("raw", "3", "x"), ("only", None, None)]
    (tmp_path / "a.jsonl").write_text('{"word":"a","lang":"L","lang_code":"l"}\n{"word":"b"}\n', encoding="utf-8")
    assert readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), "word string, lang string, lang_code string", "L").count() == 1
    with pytest.raises(ValueError):
        readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), "word string, lang string", "X")
    (tmp_path / "a.xml").write_text("<r><entry a='1'>x <b>y</b> z</entry>\n<entry>&longa;</entry><other/></r>", encoding="utf-8")
    rec = readers.read_xml_records(spark, str(tmp_path / "a.xml"), "entry", {"longa": "ā"}).orderBy("seq").collect()
    assert [r.record for r in rec] == ["<entry a='1'>x <b>y</b> z</entry>", "<entry>ā</entry>"]
    (tmp_path / "oe.txt").write_text("<PAGE NUM=1>\n<HEADER>A</HEADER>\n<B>a;</B> x\nmore\n<PAGE NUM=2>\n<B>b;</B> y\n", encoding="utf-8")
    lines = readers.classify_dictionary_lines(readers.read_lines(spark, str(tmp_path / "oe.txt")))
    assert [(r.page, r.entry) for r in readers.join_overflow(lines).orderBy("entry_no").collect()] == [(1, "<B>a;</B> x more"), (2, "<B>b;</B> y")]
    pages = spark.createDataFrame([("<p class='g'>a <b>b</b></p><p>c</p>",), (None,)], "html string")
    assert [r.texts for r in readers.html_text(pages, "html", "p", "class", "g").collect()] == [["a b"], []]
    (tmp_path / "d.sql").write_text("CREATE TABLE t (a int);\nINSERT INTO `t` VALUES (1,'it''s',NULL),(2,'a\\'b; (c)','x');\n", encoding="utf-8")
    assert sorted(tuple(r) for r in readers.read_sql_dump(spark, str(tmp_path / "d.sql"), ["a", "b", "c"]).collect()) == [("1", "it's", None), ("2", "a'b; (c)", "x")]


def test_corpus(spark, tmp_path):
    (tmp_path / "t.sty").write_text("<a. w. 1.1.1> Arma virumque, cano.\n<a. w. 1.1.2> “Troiae” qui\nno mark\n<a. w. 1.2.1> ab.\n", encoding="utf-8")
    lines = readers.read_annotated(spark, str(tmp_path / "t.sty"))
    assert lines.where("error is not null").count() == 1
    toks = corpus.tokenize(lines.where("error is null"))
    got = toks.orderBy("doc_token_index").collect()
    assert [r.token for r in got] == ["Arma", "virumque", ",", "cano", ".", "Troiae", "qui", "ab", "."] and [r.doc_token_index for r in got] == list(range(9))
    assert [r.index_sentence for r in got] == [0, 0, 0, 0, 0, 1, 1, 1, 1] and got[2].pos == "punctuation"
    assert [tuple(r)[1:] for r in corpus.layout(lines.where("error is null")).collect()] == [(True, True)]
    named = corpus.annotate(toks, lambda b: b.assign(lemma=b["token"].str.lower(), features="{}"))
    assert {r.lemma for r in named.collect()} >= {"arma"} and named.where("features is not null").count() == 0
    sections = sinks.section_json(toks.withColumn("doc", F.lit("d")))
    assert sorted(r.section for r in sections.collect()) == ["1-1", "1-2"]
    assert [r.chapters for r in sinks.section_index(toks.withColumn("doc", F.lit("d"))).collect()] == [["1", "2"]]
