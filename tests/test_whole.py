"""Queries over every row, against results made by hand."""

import __spark_entry__ as entry


def _run(spark, tmp_path, name, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    return sorted(tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect())


def test_spacing_of_separators_in_a_row(spark, tmp_path):
    rows = [(1, "a,,b"), (2, "a;:,b ;c"), (3, "a ( b,c )"), (4, "x,,,,"), (5, "1,2,,3"), (6, None)]
    got = _run(spark, tmp_path, "t10_punctuation_spacing", "documents", rows, "doc_id int, text string")
    assert got == [(1, "a, , b"), (2, "a; : , b; c"), (3, "a (b, c)"), (4, "x, , , , "), (5, "1, 2, , 3"), (6, None)]


def test_both_kinds_of_brackets(spark, tmp_path):
    rows = [("A", 1, "a [b"), ("A", 2, "b] (c"), ("A", 3, ", a (b) [c];"), ("A", 4, "a))"), ("A", 5, None)]
    got = _run(spark, tmp_path, "t11_balanced_brackets", "lex_master", rows, "lang string, lemma_id int, gloss string")
    assert got == [("A", 1, "a [b]"), ("A", 2, "[b] (c)"), ("A", 3, "a (b) [c]"), ("A", 4, "((a))")]


def test_prefix_join_of_every_language(spark, tmp_path):
    rows = [("Lat.", 1, "ab, cd, ef", "ab"), ("Lat.", 2, "ab", "ab, cd"), ("Gk.", 3, "ab", "x"), ("Gk.", 4, "x", ""), ("Goth.", 5, None, "y"), ("Goth.", 6, "y,", None)]
    got = _run(spark, tmp_path, "j5_j6_or_prefix_join", "lex_master", rows, "lang string, lemma_id int, orthography string, lemma string")
    assert got == [("Gk.", 4, 3), ("Goth.", 6, 5), ("Lat.", 1, 1), ("Lat.", 1, 2), ("Lat.", 2, 1)]


def test_places_over_every_language(spark, tmp_path):
    rows = [("Lat.", 1, "10", 1), ("Goth.", 2, "2", 1), ("Skt.", 3, "b", 1), ("ON", 4, "2a", 1), ("OE", 5, None, 1), ("Gk.", 6, "2", 1)]
    rows = [(*r, "2020") for r in rows]
    got = _run(spark, tmp_path, "o5_numeric_else_text_order", "lex_senses", rows, "lang string, sense_id int, sense_num string, h_number int, last_updated string")
    assert got == [(1, 3), (2, 1), (3, 5), (4, 4), (6, 2)]
