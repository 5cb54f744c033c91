from pyspark.sql import functions as F

from stemma.functions import markup as M
from stemma.operators import dictionary as D


def test_trees():
    e = M.parse("<e id='n1'><orth>abc</orth>, <itype>-i</itype> &nosuch; <tr>one</tr>, <tr>two</tr>; also <tr>three</tr> a < b</e>")
    assert M.inner_text(e).startswith("")  # a broken record becomes plain text
    e = M.parse("<e><orth>abc</orth>, <itype>-i</itype> &eacute; <tr>one</tr>, <tr>two</tr>; also <tr>three</tr></e>")
    assert M.gloss_of(e) == "one, two" and M.comes_before(e, "orth", "tr") and not M.comes_before(e, "tr", "orth")
    assert M.leading_run(e, {"orth", "itype"}, set()) == ["abc", "-i"] and "é" in M.inner_text(e)
    M.remove_keeping_tail(e, e.find("itype"))
    assert M.inner_text(e).startswith("abc,  é")
    assert M.textify(M.parse("<x>a<sense>b</sense><sense>c</sense> , d</x>")) == "a b c, d"
    assert M.split_numbered_divisions('x<div n="1"/>y<div n="2"/>z') == [(None, "x"), ("1", "y"), ("2", "z")]
    assert M.root_kind("H2B") == ("continuation", 2) and M.root_kind("H1") == ("headword", 1)
    assert M.pos_and_gender(["poet.", "f."]) == ("n.", "f.") and M.pos_and_gender(["a."]) == ("adj.", None)


def test_html():
    e = M.parse("<entry><m1>x <i>y</i></m1><m2>z<ref>r</ref></m2></entry>")
    assert M.write_html(e, M.RULES["oldnorse"]) == '<div class="oldnorse bodytext">x <i>y</i></div><div class="oldnorse bodytext" style="margin-left=50px">z<span class="ref">r</span></div>'
    deep = M.ET.Element("a")
    x = deep
    for _ in range(5000):
        x = M.ET.SubElement(x, "i")
    assert M.write_html(deep, M.RULES["latin"]).count("<i>") == 5000


def test_indented_entries(spark):
    xml = "<entry word='hestr'><m1><b>I)</b> <p>m.</p> <trn>horse</trn></m1><m2>1) a <i>steed</i></m2><m3>2) foal</m3><m2>3) x</m2><m1><b>II)</b> other</m1></entry>"
    df = spark.createDataFrame([(1, xml), (2, None), (3, "<entry word='a'><m1>only</m1></entry>")], "seq int, record string")
    rows = D.indented_entries(df, "record", ["seq"])
    got = [(r.seq, r.definition, r.sense_at, r.row_type, r.sense_num, r.pos) for r in rows.orderBy("seq", "definition", "sense_at").collect()]
    assert got[:4] == [(1, 1, 0, "main", "1", "n."), (1, 1, 1, "sense", "1", None), (1, 1, 2, "sense", "2", None), (1, 1, 3, "sense", "3", None)]
    assert (3, 1, 0, "main", None, None) in got and all(g[0] != 2 for g in got)
    parents = {(r.definition, r.sense_at): r.parent_at for r in D.with_parents(rows.where("seq = 1"), ["seq", "definition"], "sense_at").collect()}
    assert parents[(1, 2)] == 1 and parents[(1, 3)] is None


def test_json_entries(spark):
    rows = [
        {"word": "a", "lang": "L", "lang_code": "l", "pos": "noun", "forms": [{"form": "ā", "tags": ["canonical", "feminine"]}], "sounds": [{"ipa": "a:"}], "senses": [{"glosses": ["x", "y"]}, {"glosses": ["z"], "raw_glosses": ["(r) z"]}]},
        {"word": "b", "lang": "L", "lang_code": "l", "pos": "odd", "forms": [], "senses": [{"tags": ["no-gloss"]}]},
        {"word": "c", "lang": "L", "lang_code": "l", "senses": [{"tags": []}]},
    ]
    df = spark.createDataFrame(rows, D.JSON_RECORD).withColumn("seq", F.monotonically_increasing_id())
    got = {(r.lemma, r.sense_at): r for r in D.json_entries(df, "seq").collect()}
    assert got["a", 0].pos == "n." and got["a", 0].gender == "f." and got["a", 0].entry_str == "x; y" and got["a", 0].gloss == "x"
    assert got["a", 1].row_type == "sense" and got["a", 1].entry_str == "(r) z" and got["a", 1].pos is None
    assert got["b", 0].pos == "odd" and got["b", 0].error is None and got["c", 0].error == "no gloss"


def test_headwords_and_lines(spark):
    df = spark.createDataFrame([(1, "H1", 10, "e1"), (2, "H2", 11, None), (3, "H2B", 12, "e2"), (4, "H1", 13, None), (5, "H2", 14, "e3"), (6, "H2B", 15, "e3")], "seq int, tag string, id int, etym string").withColumn("f", F.lit("x"))
    tree = D.headword_tree(df, "tag", "seq", "id", ["f"])
    assert {r.seq: r.related for r in tree.collect()} == {1: None, 2: 10, 3: None, 4: None, 5: 13, 6: None}
    etym = D.appended_etymologies(tree, ["f"], "seq", "etym", "kind = 'headword'")
    assert {r.head: r.etym for r in etym.collect()} == {1: "e1", 2: "e2", 5: "e3"}
    lines = spark.createDataFrame([("<B>abbod;</B> es; [L. abbas] <I>m. An abbot</I> text. I. first. II. second",), ("<b>x</b> <i>to go</i>",)], "entry string")
    a, b = D.line_entries(lines).collect()
    assert (a.lemma, a.pos, a.gender, a.gloss, a.etymology) == ("abbod", "n.", "m.", "An abbot", "L. abbas") and [s.label for s in a.senses] == ["I", "II"]
    assert (b.pos, b.gloss) == ("v.", "to go")


def test_flat_records(spark):
    df = spark.createDataFrame([(1, "<e id='n1' key='k'><orth>o</orth><sense n='1' level='1'>s <tr>t</tr><cit><bibl>B</bibl><quote>q</quote></cit></sense><pb n='5'/></e>"), (2, None)], "seq int, record string")
    r = M.flatten_records(df, "record", ["seq"]).collect()
    assert len(r) == 1 and r[0].headword == "k" and r[0].translations == ["t"] and r[0].citations[0].biblio == "B" and r[0].pages == ["5"] and r[0].sense_count == 1
