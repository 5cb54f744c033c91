import json

import pytest

from stemma.operators import nested

DDL = "global_index bigint, senses_json string, citations_json string, translations_json string, k string"


NAMES = {"senses": "sense", "senses.cit": "sense_cit", "cits": "citation", "trs": "translation", "trs.alt": "translation_alt"}


def nodes(spark, wanted=None, **cols):
    df = spark.createDataFrame([(7, cols.get("senses"), cols.get("cits"), cols.get("trs"), "clash")], "global_index bigint, senses string, cits string, trs string, k string")
    return nested.flatten(df, "global_index", ["senses", "cits", "trs"], frozenset(["sub"]), wanted).collect()


def paths(spark, **cols):
    got = [r for r in nodes(spark, frozenset(NAMES), **cols) if r.node_type in ("object", "text")]
    return sorted((NAMES[r.schema_path], r.record_path, r.parent_path) for r in got)


def test_tree(spark):
    senses = json.dumps([{"def": "a", "sub": [{"n": 1, "cit": ["x", None, {"q": 1}]}, None, "bare"]}, 5, "text", {"sub": {"sub": ["deep"]}}])
    assert paths(spark, senses=senses) == [
        ("sense", "1", ""), ("sense", "1.1", "1"), ("sense", "1.3", "1"), ("sense", "3", ""), ("sense", "4", ""), ("sense", "4.1", "4"), ("sense", "4.1.1", "4.1"),
        ("sense_cit", "1.1/1", "1.1"), ("sense_cit", "1.1/3", "1.1"),
    ]


def test_lone_quoted_and_broken(spark):
    assert paths(spark, trs='{"text":"a","alt":["x","y"]}') == [("translation", "1", ""), ("translation_alt", "1/1", "1"), ("translation_alt", "1/2", "1")]
    assert paths(spark, trs='"bare word"') == [("translation", "1", "")]
    assert paths(spark, cits=json.dumps(json.dumps([{"q": 1}, "b"]))) == [("citation", "1", ""), ("citation", "2", "")]
    assert paths(spark, cits='"[{""q"":""a""}]"') == [("citation", "1", "")]
    assert paths(spark, cits='[{"q":"a"},{"q":') == []
    assert paths(spark, cits=json.dumps('[{"q":"a"},{"q":')) == []
    for empty in (None, "", " ", "null", "[]", "[null]", "{bad"):
        assert paths(spark, cits=empty) == []


def test_every_path_met(spark):
    got = {(r.schema_path, r.record_path, r.parent_path, r.node_type, r.content) for r in nodes(spark, trs='[{"x":[1,null,{"y":"z","w":{"v":true}}]},[["q"]]]')}
    assert got == {
        ("trs", "1", "", "object", "{}"), ("trs.x", "1/1", "1", "number", "1"), ("trs.x", "1/3", "1", "object", '{"y": "z", "w.v": true}'),
        ("trs.x.y", "1/3/1", "1/3", "text", '"z"'), ("trs.x.w", "1/3/1", "1/3", "object", '{"v": true}'), ("trs.x.w.v", "1/3/1/1", "1/3/1", "boolean", "true"),
        ("trs", "2", "", "list", None), ("trs[]", "2/1", "2", "list", None), ("trs[][]", "2/1/1", "2/1", "text", '"q"'),
    }


def test_broken_columns_are_told(spark):
    for text in ("{bad", '[{"q":"a"},{"q":', json.dumps('[{"q":'), "[" * 20_000, '{"a":1}}'):
        assert [(r.schema_path, r.node_type, r.record_path) for r in nodes(spark, cits=text)] == [("cits", "broken", "")]


@pytest.mark.parametrize("text", ["[]", "{}", "[{}, [], 1.5e3, -2, true, null]", '{"a":{"b":["\\u00e9\\"",{"c":{}}]}}', ' "x" ', "7"])
def test_deep_reader_reads_like_the_other(text):
    assert nested.parse_deep(text) == json.loads(text)


@pytest.mark.parametrize("text", ["[1,]", "{,}", "[1 2]", '{"a" 1}', '{"a":}', "[1]]", "]", "", "[1", '{"a":1', "[nul]", '{1:2}', '["a]', "1 2", "[}"])
def test_deep_reader_refuses(text):
    with pytest.raises(ValueError):
        nested.parse_deep(text)


def test_deep_and_empty(spark):
    for depth in (400, 3_000):
        deep = '{"sub":[' * depth + '"end"' + "]}" * depth
        got = paths(spark, senses=deep)
        assert len(got) == depth + 1 and max(p.count(".") for _, p, _ in got) == depth
    value = nested.load('{"sub":[' * 30_000 + "1" + "]}" * 30_000)
    assert sum(1 for _ in nested.walk(value, "s", frozenset(["sub"]), frozenset())) == 0
    assert nested.flatten(spark.createDataFrame([], DDL), "global_index", ["senses_json"]).count() == 0
