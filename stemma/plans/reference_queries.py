"""Queries of the dictionary operators, each with its SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import markup, text, translit
from stemma.operators import corpus, dictionary, match, merge, transliteration_match, windows
from stemma.session import table
from stemma.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: the accent- and case-insensitive key in SQL
KEY = "regexp_replace(lower(strip_accents({})), ' +$', '')"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


c, lit = F.col, F.lit

# ------------------------------------------------------------------ projections, filters, predicates


@query("""SELECT lang, lemma_id, 'main' AS kind, lemma, coalesce(lemma_translit, lemma) AS shown, page_num FROM lex_master""")
def pf1_insert_select(spark, sf):
    return table(spark, sf, "lex_master").select("lang", "lemma_id", lit("main").alias("kind"), "lemma", F.coalesce("lemma_translit", "lemma").alias("shown"), "page_num")


@query("""SELECT lang, CASE WHEN row_type <> 'sense' THEN 'main' WHEN row_type = 'sense' THEN 'sense' ELSE 'neither' END AS part, count(*) AS n
FROM lex_master GROUP BY ALL""")
def pf2_discriminator_split(spark, sf):
    part = F.when(c("row_type") != "sense", "main").when(c("row_type") == "sense", "sense").otherwise("neither")
    return table(spark, sf, "lex_master").groupBy("lang", part.alias("part")).agg(F.count(lit(1)).alias("n"))


@query("""SELECT lang, lemma_id, page_num FROM lex_master WHERE lang IN ('OE','Lat.') AND page_num BETWEEN 100 AND 300 AND row_type <> 'main'""")
def pf3_ranges_and_lists(spark, sf):
    return table(spark, sf, "lex_master").where(c("lang").isin("OE", "Lat.") & c("page_num").between(100, 300) & (c("row_type") != "main")).select("lang", "lemma_id", "page_num")


@query("""SELECT lex_ref_link_id, orig_lang_abbrev FROM lex_ref_link WHERE orig_lang_abbrev ILIKE '%lat%' OR orig_lang_abbrev LIKE '#NAME%'""")
def pf4_like(spark, sf):
    return table(spark, sf, "lex_ref_link").where(c("orig_lang_abbrev").ilike("%lat%") | c("orig_lang_abbrev").like("#NAME%")).select("lex_ref_link_id", "orig_lang_abbrev")


@query("""SELECT count(*) FILTER (word_id IS NULL) AS open_links, count(*) FILTER (word_id IS NOT NULL) AS linked FROM lex_ref_link""")
def pf6_null_tests(spark, sf):
    return table(spark, sf, "lex_ref_link").agg(F.count_if(c("word_id").isNull()).alias("open_links"), F.count_if(c("word_id").isNotNull()).alias("linked"))


@query("""SELECT r.lex_ref_link_id FROM lex_ref_link r LEFT JOIN lex_master m ON r.word_id = m.lemma_id AND r.word_lang = m.lang
WHERE r.word_id IS NOT NULL AND m.lemma_id IS NULL""")
def pf7_outer_side_filter(spark, sf):
    r = table(spark, sf, "lex_ref_link").where("word_id is not null")
    m = table(spark, sf, "lex_master").select("lemma_id", "lang")
    return r.join(m, (r.word_id == m.lemma_id) & (r.word_lang == m.lang), "left_anti").select("lex_ref_link_id")


@query("""SELECT doc_id, lang FROM documents WHERE lang = 'de'""")
def pf8_language_filter(spark, sf):
    return table(spark, sf, "documents").where(c("lang") == "de").select("doc_id", "lang")


@query("""SELECT lower(trim(coalesce(lang, ''))) IN ('', 'nan') AS missing, count(*) AS n FROM lex_ref_link GROUP BY 1""")
def pf9_blank(spark, sf):
    return table(spark, sf, "lex_ref_link").groupBy(text.is_blank(c("lang")).alias("missing")).agg(F.count(lit(1)).alias("n"))


@query("""SELECT lex_ref_link_id, CASE WHEN regexp_matches(trim(orig_lang_abbrev), '^\\?\\s*\\p{L}+\\.$', 'i') THEN 1 ELSE coalesce(TRY_CAST(questionable AS INT), 0) END AS flag
FROM lex_ref_link WHERE orig_lang_abbrev IS NOT NULL""")
def pf10_regex_flag(spark, sf):
    hit = F.trim("orig_lang_abbrev").rlike(r"(?iu)^\?\s*\p{L}+\.$")
    return table(spark, sf, "lex_ref_link").where("orig_lang_abbrev is not null").select("lex_ref_link_id", F.when(hit, 1).otherwise(F.coalesce(c("questionable").try_cast("int"), lit(0))).alias("flag"))


@query("""SELECT coalesce(lang, 'und') AS lang, count(*) AS n FROM documents GROUP BY 1""")
def pf12_fill_language(spark, sf):
    return table(spark, sf, "documents").groupBy(F.coalesce("lang", lit("und")).alias("lang")).agg(F.count(lit(1)).alias("n"))


# ------------------------------------------------------------------ joins


def _words(spark, sf):
    return table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "lang", "reflex", "reflex_normalized", "gloss_eng").where("lang is not null and reflex is not null")


def _lemmas(spark, sf):
    return table(spark, sf, "lex_master").select("lang", "lemma_id", "lemma", "lemma_normalized", "gloss", "entry_str", "page_num").where("lemma is not null")


@query(f"""SELECT r.lex_ref_link_id, r.lang, m.lemma_id FROM lex_ref_link r JOIN lex_master m ON r.lang = m.lang AND {KEY.format('r.reflex')} = {KEY.format('m.lemma')}""")
def j1_literal_match(spark, sf):
    return match.literal_match(_words(spark, sf), _lemmas(spark, sf).select("lang", "lemma_id", "lemma"), "reflex", "lemma", ["lang"]).select("lex_ref_link_id", "lang", "lemma_id")


@query(f"""SELECT r.lang, count(*) AS join_rows, count(DISTINCT r.lex_ref_link_id) AS words, count(DISTINCT m.lemma_id) AS lemmas
FROM (SELECT * FROM lex_ref_link WHERE lang IS NOT NULL AND reflex IS NOT NULL) r LEFT JOIN (SELECT * FROM lex_master WHERE lemma IS NOT NULL) m
ON r.lang = m.lang AND {KEY.format('r.reflex')} = {KEY.format('m.lemma')} GROUP BY 1""")
def j2_a1_match_coverage(spark, sf):
    joined = match.literal_match(_words(spark, sf), _lemmas(spark, sf).select("lang", "lemma_id", "lemma"), "reflex", "lemma", ["lang"], "left")
    return joined.groupBy("lang").agg(F.count(lit(1)).alias("join_rows"), F.count_distinct("lex_ref_link_id").alias("words"), F.count_distinct("lemma_id").alias("lemmas"))


@query(f"""SELECT r.lex_ref_link_id, m.lemma_id FROM lex_ref_link r JOIN lex_master m ON r.lang = 'ON' AND m.lang = 'ON' AND {KEY.format('r.reflex_normalized')} = {KEY.format('m.lemma_normalized')}""")
def j3_normalized_match(spark, sf):
    r, m = _words(spark, sf).where("lang = 'ON'"), _lemmas(spark, sf).where("lang = 'ON'").select("lang", "lemma_id", "lemma_normalized")
    return match.literal_match(r, m, "reflex_normalized", "lemma_normalized", ["lang"]).select("lex_ref_link_id", "lemma_id")


_MATCH_KEY = r"nullif(regexp_extract(trim(regexp_replace(regexp_replace(regexp_replace(translate({0},'vj','ui'),'[-()*]','','g'),'[0-9]','','g'),' +',' ','g')),'[\p{{L}}\p{{M}}\p{{N}}_]+'),'')"


@query(f"""SELECT r.lex_ref_link_id, m.lemma_id FROM (SELECT lex_ref_link_id, lang, {_MATCH_KEY.format('reflex')} AS k FROM lex_ref_link) r
LEFT JOIN (SELECT lang, lemma_id, {_MATCH_KEY.format('lemma')} AS k FROM lex_master) m ON r.lang = m.lang AND r.k = m.k WHERE r.lang = 'Lat.'""")
def j4_derived_key_match(spark, sf):
    r = table(spark, sf, "lex_ref_link").where("lang = 'Lat.'").select("lex_ref_link_id", text.match_key(c("reflex")).alias("k"))
    m = table(spark, sf, "lex_master").where("lang = 'Lat.'").select("lemma_id", text.match_key(c("lemma")).alias("k"))
    return r.join(m, "k", "left").select("lex_ref_link_id", "lemma_id")


@query(r"""WITH p AS (SELECT lex_ref_link_id, lang, reflex AS lemma, TRY_CAST(regexp_extract(page_loc, '(\d{1,6})', 1) AS INT) AS page FROM lex_ref_link), m AS (SELECT lang, lemma_id, page_num, lemma || ' (' || coalesce(lemma_translit, lemma) || ')' AS shown FROM lex_master)
SELECT p.lex_ref_link_id, m.lemma_id FROM p JOIN m ON p.lang = m.lang AND left(m.shown, greatest(instr(m.shown, ' (') - 1, 0)) = p.lemma AND p.page = m.page_num""")
def j5_composite_expression_key(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "lang", c("reflex").alias("word"), F.regexp_extract("page_loc", r"(\d{1,6})", 1).try_cast("int").alias("page_num"))
    shown = F.concat("lemma", lit(" ("), F.coalesce("lemma_translit", "lemma"), lit(")"))
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "page_num", match.trimmed_lemma(shown).alias("word"))
    return r.join(m, ["lang", "word", "page_num"]).select("lex_ref_link_id", "lemma_id")


def _or_prefix(rows):
    m = rows.select("lang", "lemma_id", "orthography")
    s = rows.where(c("lemma") != "").select("lang", c("lemma_id").alias("other_id"), c("lemma").alias("other"))
    return match.equal_or_listed(m, s, "orthography", "other", ["lang"]).select("lang", "lemma_id", "other_id").distinct()


@query("""SELECT DISTINCT m.lang, m.lemma_id, s.lemma_id AS other_id FROM (SELECT lang, lemma_id, unnest(list_append(
[left(orthography, i - 1) FOR i IN range(1, length(orthography) + 1) IF substring(orthography, i, 1) = ','], orthography)) AS k FROM lex_master WHERE orthography IS NOT NULL) m
JOIN lex_master s ON m.lang = s.lang AND m.k = s.lemma WHERE s.lemma <> ''""")
def j5_j6_or_prefix_join(spark, sf):
    return _or_prefix(table(spark, sf, "lex_master"))


@query(r"""SELECT DISTINCT d.doc_id, s.abbrev_id FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')) AS w FROM documents) d
JOIN lang_abbrev_master s ON d.w = lower(s.full_language_name)""")
def j7_word_containment(spark, sf):
    names = table(spark, sf, "lang_abbrev_master").select("abbrev_id", "full_language_name")
    return match.contains_word(table(spark, sf, "documents").select("doc_id", "text"), names, "text", "full_language_name").select("doc_id", "abbrev_id").distinct()


@query("""SELECT r.lex_ref_link_id, rt.rt_shape, m.lemma, s.gloss AS sense_gloss FROM lex_ref_link r JOIN rt_ref_link rt ON r.rt_ref_link_id = rt.rt_ref_link_id
JOIN lex_master m ON r.word_id = m.lemma_id AND r.word_lang = m.lang JOIN lex_senses s ON s.lang = m.lang AND s.lemma_id = m.lemma_id""")
def j8_star_join(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "rt_ref_link_id", c("word_id").alias("lemma_id"), c("word_lang").alias("lang"))
    rt = table(spark, sf, "rt_ref_link").select("rt_ref_link_id", "rt_shape")
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "lemma")
    s = table(spark, sf, "lex_senses").select("lang", "lemma_id", c("gloss").alias("sense_gloss"))
    return r.where("lemma_id is not null").join(rt, "rt_ref_link_id").join(m, ["lang", "lemma_id"]).join(s, ["lang", "lemma_id"]).select("lex_ref_link_id", "rt_shape", "lemma", "sense_gloss")


@query("""SELECT s.sense_id, m.page_num FROM lex_senses s JOIN lex_master m ON s.lang = m.lang AND s.lemma_id = m.lemma_id""")
def j9_composite_key(spark, sf):
    return table(spark, sf, "lex_senses").select("sense_id", "lang", "lemma_id").join(table(spark, sf, "lex_master").select("lang", "lemma_id", "page_num"), ["lang", "lemma_id"]).select("sense_id", "page_num")


@query("""SELECT m.lemma_id, r.lex_ref_link_id FROM (SELECT * FROM lex_master WHERE lang = 'Skt.') m LEFT JOIN lex_ref_link r ON r.word_id = m.lemma_id AND r.word_lang = 'Skt.'""")
def j10_constant_on_predicate(spark, sf):
    r = table(spark, sf, "lex_ref_link").where("word_lang = 'Skt.'").select(c("word_id").alias("lemma_id"), "lex_ref_link_id")
    return table(spark, sf, "lex_master").where("lang = 'Skt.'").select("lemma_id").join(r, "lemma_id", "left")


@query("""SELECT lex_ref_link_id FROM lex_ref_link WHERE word_id NOT IN (SELECT lemma_id FROM lex_master WHERE lang = 'ON')""")
def j11_not_in(spark, sf):
    listed = table(spark, sf, "lex_master").where("lang = 'ON'")
    return match.not_in(table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "word_id"), listed, "word_id", "lemma_id").select("lex_ref_link_id")


@query("""SELECT lang, lemma_id, lemma FROM lex_master WHERE (lang, lemma) IN (SELECT (lang, lemma) FROM (SELECT DISTINCT lang, lemma, lemma_id FROM lex_master) GROUP BY lang, lemma HAVING count(*) > 1)""")
def j12_a2_in_grouped_subquery(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "lemma")
    several = m.distinct().groupBy("lang", "lemma").agg(F.count(lit(1)).alias("n")).where("n > 1")
    return m.join(several, ["lang", "lemma"], "left_semi").select("lang", "lemma_id", "lemma")


@query("""SELECT m.lang, m.lemma_id FROM lex_master m WHERE NOT EXISTS (SELECT 1 FROM lex_senses s WHERE s.lang = m.lang AND s.lemma_id = m.lemma_id)""")
def j13_not_exists(spark, sf):
    return table(spark, sf, "lex_master").select("lang", "lemma_id").join(table(spark, sf, "lex_senses").select("lang", "lemma_id"), ["lang", "lemma_id"], "left_anti")


@query("""SELECT m.lang, m.lemma_id FROM lex_master m WHERE EXISTS (SELECT 1 FROM lex_senses s WHERE s.lang = m.lang AND s.lemma_id = m.lemma_id AND s.gloss IS NOT NULL)""")
def j14_exists(spark, sf):
    s = table(spark, sf, "lex_senses").where("gloss is not null").select("lang", "lemma_id")
    return table(spark, sf, "lex_master").select("lang", "lemma_id").join(s, ["lang", "lemma_id"], "left_semi")


@query("""SELECT m.lang, m.lemma_id FROM lex_master m LEFT JOIN lex_ref_link r ON r.word_lang = m.lang AND r.word_id = m.lemma_id WHERE r.word_id IS NULL""")
def j15_anti_by_outer_join(spark, sf):
    linked = table(spark, sf, "lex_ref_link").select(c("word_lang").alias("lang"), c("word_id").alias("lemma_id"))
    return table(spark, sf, "lex_master").select("lang", "lemma_id").join(linked, ["lang", "lemma_id"], "left_anti")


@query("""SELECT 'reflex' AS which, count(*) AS n FROM (SELECT DISTINCT * FROM temp_on_matching) t JOIN (SELECT DISTINCT * FROM temp_on_matching) a ON t.lex_ref_link_id = a.lex_ref_link_id AND t.lemma_id <> a.lemma_id
UNION ALL SELECT 'lemma', count(*) FROM (SELECT DISTINCT * FROM temp_on_matching) t JOIN (SELECT DISTINCT * FROM temp_on_matching) a ON t.lemma_id = a.lemma_id AND t.lex_ref_link_id <> a.lex_ref_link_id""")
def j16_duplicates_on_either_key(spark, sf):
    t = table(spark, sf, "temp_on_matching").distinct()
    a, b = t.alias("a"), t.alias("b")
    x = a.join(b, (c("a.lex_ref_link_id") == c("b.lex_ref_link_id")) & (c("a.lemma_id") != c("b.lemma_id"))).agg(lit("reflex").alias("which"), F.count(lit(1)).alias("n"))
    y = a.join(b, (c("a.lemma_id") == c("b.lemma_id")) & (c("a.lex_ref_link_id") != c("b.lex_ref_link_id"))).agg(lit("lemma").alias("which"), F.count(lit(1)).alias("n"))
    return x.unionByName(y)


@query(r"""WITH k AS (SELECT key, min(code) AS code FROM (SELECT lower(regexp_replace(trim(unnest(string_split(source_abbrev, ',')), ' '), '\s+', ' ', 'g')) AS key, eng_abbrev AS code FROM lang_abbrev_master) WHERE key <> '' GROUP BY 1),
u AS (SELECT lower(regexp_replace(trim(orig_lang_abbrev_raw, ' '), '\s+', ' ', 'g')) AS key, sum(row_count)::BIGINT AS row_count FROM unmapped_summary GROUP BY 1)
SELECT l.lex_ref_link_id, CASE WHEN coalesce(trim(l.lang, ' '), '') = '' THEN k.code ELSE l.lang END AS lang, u.row_count FROM (SELECT *, lower(regexp_replace(trim(orig_lang_abbrev, ' '), '\s+', ' ', 'g')) AS key FROM lex_ref_link) l LEFT JOIN k USING (key) LEFT JOIN u USING (key)""")
def j18_j20_left_merge_lookup(spark, sf):
    key = lambda x: text.abbreviation_key(c(x))
    k = table(spark, sf, "lang_abbrev_master").select(F.explode(F.split("source_abbrev", ",")).alias("a"), c("eng_abbrev").alias("code")).withColumn("key", key("a")).where("key <> ''").groupBy("key").agg(F.min("code").alias("code"))
    u = table(spark, sf, "unmapped_summary").groupBy(key("orig_lang_abbrev_raw").alias("key")).agg(F.sum("row_count").alias("row_count"))
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "lang", key("orig_lang_abbrev").alias("key"))
    blank = F.trim(F.coalesce("lang", lit(""))) == ""
    return r.join(k, "key", "left").join(u, "key", "left").select("lex_ref_link_id", F.when(blank, c("code")).otherwise(c("lang")).alias("lang"), "row_count")


@query("""SELECT r.lex_ref_link_id, coalesce(r.lang, k.lang) AS lang FROM lex_ref_link r LEFT JOIN (SELECT orig_lang_abbrev, arg_max(lang, lex_ref_link_id) AS lang FROM lex_ref_link WHERE lang IS NOT NULL AND orig_lang_abbrev IS NOT NULL GROUP BY 1) k
ON r.orig_lang_abbrev = k.orig_lang_abbrev""")
def j19_map_last_value(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "orig_lang_abbrev", "lang")
    last = r.where("lang is not null and orig_lang_abbrev is not null").groupBy("orig_lang_abbrev").agg(F.max_by("lang", "lex_ref_link_id").alias("known"))
    return r.join(last, "orig_lang_abbrev", "left").select("lex_ref_link_id", F.coalesce("lang", "known").alias("lang"))


# ------------------------------------------------------------------ updates and merges


@query("""SELECT r.lex_ref_link_id, coalesce(t.lemma_id, r.word_id) AS word_id FROM lex_ref_link r LEFT JOIN (SELECT lex_ref_link_id, min(lemma_id) AS lemma_id FROM temp_on_matching GROUP BY 1) t USING (lex_ref_link_id)""")
def u1_update_from_join(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "word_id")
    return merge.update_from(r, table(spark, sf, "temp_on_matching"), ["lex_ref_link_id"], {"word_id": "lemma_id"})


@query("""SELECT r.lex_ref_link_id, t.lemma_id AS word_id FROM lex_ref_link r LEFT JOIN (SELECT lex_ref_link_id, min(lemma_id) AS lemma_id FROM temp_on_matching GROUP BY 1) t USING (lex_ref_link_id)""")
def u2_update_clears_unmatched(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "word_id")
    return merge.update_from(r, table(spark, sf, "temp_on_matching"), ["lex_ref_link_id"], {"word_id": "lemma_id"}, clear_unmatched=True)


@query("""SELECT r.lex_ref_link_id, CASE WHEN r.word_id IS NULL AND r.lang = 'ON' THEN t.lemma_id ELSE r.word_id END AS word_id FROM lex_ref_link r
LEFT JOIN (SELECT lex_ref_link_id, min(lemma_id) AS lemma_id FROM temp_on_matching GROUP BY 1) t USING (lex_ref_link_id)""")
def u3_conditional_update(spark, sf):
    t = table(spark, sf, "temp_on_matching").groupBy("lex_ref_link_id").agg(F.min("lemma_id").alias("new_id"))
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "word_id", "lang").join(t, "lex_ref_link_id", "left")
    return r.select("lex_ref_link_id", F.when(c("word_id").isNull() & (c("lang") == "ON"), c("new_id")).otherwise(c("word_id")).alias("word_id"))


@query("""SELECT lang, lemma_id, CASE WHEN pos = 'n.' AND gender IS NOT NULL THEN pos || ' ' || gender ELSE pos END AS pos, CASE WHEN pos LIKE 'mf%n.' THEN 'adj.' ELSE gender END AS gender FROM lex_master""")
def u4_computed_update(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "pos", "gender")
    return m.select("lang", "lemma_id", F.when((c("pos") == "n.") & c("gender").isNotNull(), F.concat_ws(" ", "pos", "gender")).otherwise(c("pos")).alias("pos"), F.when(c("pos").like("mf%n."), "adj.").otherwise(c("gender")).alias("gender"))


@query("""SELECT lang, lemma_id, gloss FROM lex_master WHERE lang NOT IN ('OE', 'ON') OR lang IS NULL UNION ALL SELECT lang, lemma_id, upper(gloss) FROM lex_master WHERE lang IN ('OE', 'ON')""")
def u5_slice_overwrite(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "gloss")
    return merge.slice_overwrite(m, m.where(c("lang").isin("OE", "ON")).withColumn("gloss", F.upper("gloss")), "lang")


@query("""SELECT lang, count(*) AS n FROM (SELECT lang, lemma_id FROM lex_master WHERE page_num IS NULL UNION ALL SELECT lang, lemma_id FROM lex_master WHERE page_num IS NOT NULL AND (lang, lemma_id) NOT IN (SELECT (lang, lemma_id) FROM lex_master WHERE page_num IS NULL)) GROUP BY 1""")
def u6_append_new(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "page_num")
    grown, _ = merge.append_new(m.where("page_num is null").drop("page_num"), m.where("page_num is not null").drop("page_num"), ["lang", "lemma_id"])
    return grown.groupBy("lang").agg(F.count(lit(1)).alias("n"))


@query("""SELECT 'kept' AS part, count(*) AS n FROM lex_ref_link WHERE NOT coalesce(questionable = '1', false) UNION ALL SELECT 'moved', count(*) FROM lex_ref_link WHERE questionable = '1'""")
def u7_move_rows(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "questionable")
    kept, moved = merge.move_rows(r, r.where("false"), "questionable = '1'")
    return kept.agg(lit("kept").alias("part"), F.count(lit(1)).alias("n")).unionByName(moved.agg(lit("moved").alias("part"), F.count(lit(1)).alias("n")))


@query("""SELECT lex_ref_link_id FROM lex_ref_link WHERE lex_ref_link_id NOT IN (3, 5, 8) AND lex_ref_link_id NOT IN (SELECT lex_ref_link_id FROM temp_on_matching)""")
def u8_delete_by_list_and_semi_join(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id").where(~c("lex_ref_link_id").isin(3, 5, 8))
    return r.join(table(spark, sf, "temp_on_matching").select("lex_ref_link_id"), "lex_ref_link_id", "left_anti")


@query("""SELECT r.lex_ref_link_id, r.word_lang, r.word_id FROM lex_ref_link r WHERE r.word_id IS NOT NULL AND r.word_lang IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lex_senses s WHERE s.lang = r.word_lang AND s.lemma_id = r.word_id)""")
def u10_demotion_report(spark, sf):
    r = table(spark, sf, "lex_ref_link").select("lex_ref_link_id", "word_lang", "word_id")
    return merge.dangling(r, table(spark, sf, "lex_senses"), ["word_lang", "word_id"], ["lang", "lemma_id"])


# ------------------------------------------------------------------ aggregation, order, sets


@query("""SELECT lang, lemma_id, string_agg(DISTINCT h_number, ', ' ORDER BY h_number) AS h_numbers FROM lex_senses WHERE h_number IS NOT NULL GROUP BY ALL""")
def a3_a4_group_concat(spark, sf):
    return table(spark, sf, "lex_senses").where("h_number is not null").groupBy("lang", "lemma_id").agg(F.array_join(F.array_sort(F.collect_set("h_number")), ", ").alias("h_numbers"))


@query("""SELECT lang, max(lemma_id) + 1 AS next_id FROM lex_master GROUP BY 1""")
def a5_src16_next_id(spark, sf):
    return table(spark, sf, "lex_master").groupBy("lang").agg((F.max("lemma_id") + 1).alias("next_id"))


@query("""SELECT (SELECT count(*) FROM lex_master) AS entries, (SELECT count(*) FROM lex_senses) AS senses, (SELECT count(*) FROM lex_ref_link) AS links, (SELECT count(*) FROM rt_ref_link) AS roots""")
def a6_summary_row(spark, sf):
    names = (("entries", "lex_master"), ("senses", "lex_senses"), ("links", "lex_ref_link"), ("roots", "rt_ref_link"))
    row = None
    for alias, name in names:
        one = table(spark, sf, name).agg(F.count(lit(1)).alias(alias))
        row = one if row is None else row.crossJoin(one)
    return row


@query("""SELECT DISTINCT * FROM temp_on_matching""")
def a7_distinct_rows(spark, sf):
    return table(spark, sf, "temp_on_matching").distinct()


@query("""SELECT lower(tag) AS tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(entry, '<([A-Za-z][A-Za-z0-9]*)', 1)) AS tag FROM lex_master) GROUP BY 1""")
def a8_t21_m21_tag_census(spark, sf):
    return table(spark, sf, "lex_master").select(F.explode(text.tags(c("entry"))).alias("tag")).groupBy(F.lower("tag").alias("tag")).agg(F.count(lit(1)).alias("n"))


@query("""SELECT tag, attribute, count(*) AS n FROM (SELECT regexp_extract(t, '<(\\w+)', 1) AS tag, unnest(regexp_extract_all(t, ' (\\w+)=', 1)) AS attribute FROM (SELECT unnest(regexp_extract_all(entry, '<\\w+ [^>]*>')) AS t FROM lex_master)) GROUP BY ALL""")
def a8_m21_attribute_census(spark, sf):
    opened = table(spark, sf, "lex_master").select(F.explode(F.regexp_extract_all("entry", lit(r"<\w+ [^>]*>"), lit(0))).alias("t"))
    pairs = opened.select(F.regexp_extract("t", r"<(\w+)", 1).alias("tag"), F.explode(F.regexp_extract_all("t", lit(r" (\w+)="), lit(1))).alias("attribute"))
    return pairs.groupBy("tag", "attribute").agg(F.count(lit(1)).alias("n"))


@query("""SELECT orig_lang_abbrev, count(*) AS n FROM lex_ref_link WHERE orig_lang_abbrev IS NOT NULL GROUP BY 1 ORDER BY n DESC, orig_lang_abbrev LIMIT 50""")
def a9_top_values(spark, sf):
    return table(spark, sf, "lex_ref_link").where("orig_lang_abbrev is not null").groupBy("orig_lang_abbrev").agg(F.count(lit(1)).alias("n")).orderBy(F.desc("n"), "orig_lang_abbrev").limit(50)


@query("""SELECT lang, lemma_id, count(*) AS n_senses, arg_min(gloss, sense_id) FILTER (gloss IS NOT NULL) AS first_gloss, arg_min(sense_num, sense_id) FILTER (sense_num IS NOT NULL) AS first_label
FROM (SELECT DISTINCT lang, lemma_id, sense_id, gloss, sense_num FROM lex_senses) GROUP BY ALL""")
def a10_first_non_empty(spark, sf):
    s = table(spark, sf, "lex_senses").select("lang", "lemma_id", "sense_id", "gloss", "sense_num").distinct()
    pick = lambda x: F.min(F.when(c(x).isNotNull(), F.struct("sense_id", x)))[x]
    return s.groupBy("lang", "lemma_id").agg(F.count(lit(1)).alias("n_senses"), pick("gloss").alias("first_gloss"), pick("sense_num").alias("first_label"))


@query("""SELECT rt_master_id, string_agg(ref_id, ',' ORDER BY first_seen, ref_id) AS sources FROM (SELECT rt_master_id, ref_id, min(rt_ref_link_id) AS first_seen FROM rt_ref_link WHERE ref_id IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def a11_ordered_distinct_list(spark, sf):
    seen = table(spark, sf, "rt_ref_link").where("ref_id is not null").groupBy("rt_master_id", "ref_id").agg(F.min("rt_ref_link_id").alias("first_seen"))
    return seen.groupBy("rt_master_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_seen", "ref_id"))), lambda x: x["ref_id"]), ",").alias("sources"))


@query("""SELECT lang, lemma_id, count(*) AS n_senses, count(gloss) > 0 AS has_gloss FROM lex_senses GROUP BY ALL""")
def a12_counts_and_flags(spark, sf):
    return table(spark, sf, "lex_senses").groupBy("lang", "lemma_id").agg(F.count(lit(1)).alias("n_senses"), (F.count("gloss") > 0).alias("has_gloss"))


@query("""SELECT orig_lang_abbrev, count(DISTINCT lang) AS n_langs FROM lex_ref_link WHERE orig_lang_abbrev IS NOT NULL GROUP BY 1 HAVING count(DISTINCT lang) > 1""")
def a13_collisions(spark, sf):
    return table(spark, sf, "lex_ref_link").where("orig_lang_abbrev is not null").groupBy("orig_lang_abbrev").agg(F.count_distinct("lang").alias("n_langs")).where("n_langs > 1")


# the SQL engine counts edits in bytes: letters outside ASCII stand as one sign in both
_ASCII = "regexp_replace({}, '[^ -~]', '?', 'g')"
_SIM = "CASE WHEN greatest(length(a), length(b)) = 0 THEN 100.0 ELSE round(100.0 * (1 - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b))), 4) END"


def _ascii(name):
    return F.regexp_replace(name, "[^ -~]", "?").alias(name)


@query(f"""WITH p AS (SELECT DISTINCT lex_ref_link_id, lemma_id, {_ASCII.format('reflex')} AS a, {_ASCII.format('lemma')} AS b FROM temp_on_matching WHERE reflex IS NOT NULL AND lemma IS NOT NULL), s AS (SELECT *, {_SIM} AS score FROM p)
SELECT lex_ref_link_id, lemma_id, score FROM (SELECT *, row_number() OVER (PARTITION BY lex_ref_link_id ORDER BY score DESC, lemma_id, b) AS r FROM s) WHERE r = 1""")
def a14_best_candidate(spark, sf):
    p = table(spark, sf, "temp_on_matching").where("reflex is not null and lemma is not null").select("lex_ref_link_id", "lemma_id", _ascii("reflex"), _ascii("lemma")).distinct()
    p = p.withColumn("score", F.round(match.similarity(c("reflex"), c("lemma")), 4))
    return match.best_candidate(p, ["lex_ref_link_id"], c("score"), [c("lemma_id"), c("lemma")]).select("lex_ref_link_id", "lemma_id", "score")


@query("""SELECT lang, lemma_id, lemma FROM lex_master WHERE lang IS NOT NULL ORDER BY lang, lemma_id, lemma, page_num, gloss LIMIT 100 OFFSET 50""")
def o1_o2_order_limit_offset(spark, sf):
    m = table(spark, sf, "lex_master").where("lang is not null").select("lang", "lemma_id", "lemma", "page_num", "gloss")
    return m.orderBy("lang", "lemma_id", "lemma", F.asc_nulls_last("page_num"), F.asc_nulls_last("gloss")).offset(50).limit(100).select("lang", "lemma_id", "lemma")


@query("""SELECT parsed_id, place, (place - 1) // 1000 AS page FROM (SELECT parsed_id, row_number() OVER (ORDER BY TRY_CAST(replace(parsed_id, '*', '') AS BIGINT), lang) AS place FROM (SELECT DISTINCT '*' || lemma_id AS parsed_id, lang FROM lex_master WHERE lang IS NOT NULL))""")
def o1_o3_star_ids_in_pages(spark, sf):
    ids = table(spark, sf, "lex_master").where("lang is not null").select(F.concat(lit("*"), c("lemma_id").cast("string")).alias("parsed_id"), "lang").distinct()
    numbered = windows.global_row_number(ids, [match.star_id(c("parsed_id")), c("lang")], "place")
    return numbered.select("parsed_id", "place", F.floor((c("place") - 1) / 1000).alias("page"))


def _numeric_else_text(senses):
    n = c("sense_num").try_cast("double")
    order = [n.isNull(), n, c("sense_num"), c("sense_id"), c("h_number"), c("last_updated")]
    return windows.global_row_number(senses.where("sense_num is not null"), order, "place").select("sense_id", "place")


@query("""SELECT sense_id, row_number() OVER (ORDER BY TRY_CAST(sense_num AS DOUBLE) IS NULL, TRY_CAST(sense_num AS DOUBLE), sense_num, sense_id, h_number, last_updated) AS place FROM lex_senses WHERE sense_num IS NOT NULL""")
def o5_numeric_else_text_order(spark, sf):
    return _numeric_else_text(table(spark, sf, "lex_senses"))


@query("""SELECT lang, lemma_id AS id FROM lex_master UNION ALL SELECT lang, sense_id FROM lex_senses""")
def o6_union_all(spark, sf):
    return table(spark, sf, "lex_master").select("lang", c("lemma_id").alias("id")).unionByName(table(spark, sf, "lex_senses").select("lang", c("sense_id").alias("id")))


@query(f"""WITH r AS (SELECT lex_ref_link_id AS id, {KEY.format('reflex')} AS k FROM lex_ref_link WHERE lang = 'ON'), m AS (SELECT lemma_id AS id, {KEY.format('lemma')} AS k FROM lex_master WHERE lang = 'ON')
SELECT 'left' AS side, id, bool_or(k IS NOT NULL AND k IN (SELECT k FROM m WHERE k IS NOT NULL)) AS has_candidate FROM r WHERE id NOT IN (SELECT lex_ref_link_id FROM temp_on_matching) GROUP BY 2
UNION ALL SELECT 'right', id, bool_or(k IS NOT NULL AND k IN (SELECT k FROM r WHERE k IS NOT NULL)) FROM m WHERE id NOT IN (SELECT lemma_id FROM temp_on_matching) GROUP BY 2""")
def o7_k16_missing_pairings(spark, sf):
    r = table(spark, sf, "lex_ref_link").where("lang = 'ON'").select("lex_ref_link_id", text.fold_key(c("reflex")).alias("key"))
    m = table(spark, sf, "lex_master").where("lang = 'ON'").select("lemma_id", text.fold_key(c("lemma")).alias("key"))
    return match.missing_pairings(r, m, table(spark, sf, "temp_on_matching"), "lex_ref_link_id", "lemma_id")


# ------------------------------------------------------------------ windows


@query("""SELECT lang, lemma_id, row_number() OVER (ORDER BY lang, lemma_id) + 1000000 AS new_id FROM (SELECT DISTINCT lang, lemma_id FROM lex_master)""")
def w1_k17_new_ids(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id").distinct()
    return windows.global_row_number(m, [c("lang"), c("lemma_id")], "new_id", 1_000_000)


@query("""SELECT lex_ref_link_id, lemma_id, CASE WHEN count(*) OVER (PARTITION BY lex_ref_link_id) = 1 THEN 'unique' ELSE 'ambiguous' END AS part FROM (SELECT DISTINCT lex_ref_link_id, lemma_id FROM temp_on_matching)""")
def w2_unique_or_ambiguous(spark, sf):
    t = table(spark, sf, "temp_on_matching").select("lex_ref_link_id", "lemma_id").distinct()
    return t.withColumn("part", windows.unique_or_ambiguous(["lex_ref_link_id"]))


@query("""SELECT lang, lemma_id, last_value(page_num IGNORE NULLS) OVER (PARTITION BY lang ORDER BY lemma_id ROWS UNBOUNDED PRECEDING) AS page FROM (SELECT lang, lemma_id, max(page_num) AS page_num FROM lex_master GROUP BY ALL)""")
def w3_fill_forward(spark, sf):
    m = table(spark, sf, "lex_master").groupBy("lang", "lemma_id").agg(F.max("page_num").alias("page_num"))
    return windows.fill_forward(m, "page_num", ["lang"], "lemma_id", "page").select("lang", "lemma_id", "page")


_RUNS = "(SELECT *, sum(changed) OVER (PARTITION BY lang ORDER BY lemma_id) AS run FROM (SELECT *, CASE WHEN lag(lemma) OVER w IS NOT DISTINCT FROM lemma AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS changed FROM (SELECT lang, lemma_id, max(lemma) AS lemma, max(row_type) AS row_type FROM lex_master GROUP BY ALL) WINDOW w AS (PARTITION BY lang ORDER BY lemma_id)))"


@query(f"""SELECT lang, lemma_id, lemma, CASE WHEN main AND sum(main::INT) OVER (PARTITION BY lang, run) > 1 THEN CAST(sum(main::INT) OVER (PARTITION BY lang, run ORDER BY lemma_id) AS BIGINT) END AS sense_num
FROM (SELECT *, row_type <> 'hapax' AS main FROM {_RUNS})""")
def w4_renumber_homonyms(spark, sf):
    m = table(spark, sf, "lex_master").groupBy("lang", "lemma_id").agg(F.max("lemma").alias("lemma"), F.max("row_type").alias("row_type"))
    return windows.renumber_homonyms(m, ["lang"], "lemma_id", "lemma", c("row_type") != "hapax").select("lang", "lemma_id", "lemma", "sense_num")


_SENSES = "(SELECT lang, sense_id, arg_max(lemma_id, last_updated) AS lemma_id, max(h_number) AS h_number FROM (SELECT lang, sense_id, lemma_id, h_number, last_updated FROM lex_senses) GROUP BY lang, sense_id)"


@query(f"""SELECT lang, sense_id, row_number() OVER (PARTITION BY lang ORDER BY sense_id) AS sense_no, coalesce(h_number, 'n' || lemma_id || '.' || (row_number() OVER (PARTITION BY lang, lemma_id ORDER BY sense_id) - 1)) AS h_filled FROM {_SENSES}""")
def w5_number_senses(spark, sf):
    s = table(spark, sf, "lex_senses").groupBy("lang", "sense_id").agg(F.max_by("lemma_id", "last_updated").alias("lemma_id"), F.max("h_number").alias("h_number"))
    return windows.number_senses(s, ["lang"], "lemma_id", "sense_id").select("lang", "sense_id", "sense_no", "h_filled")


_LEVELS = "(SELECT lang, lemma_id, sense_id, CASE WHEN regexp_matches(label, '^[IVX]+$') THEN 0 WHEN regexp_matches(label, '^[A-Z]$') THEN 1 WHEN regexp_matches(label, '^[0-9]+$') THEN 2 WHEN label IS NOT NULL THEN 3 END AS lv, label FROM (SELECT lang, lemma_id, sense_id, max(sense_num) AS label FROM lex_senses GROUP BY ALL))"


def _leveled(spark, sf):
    s = table(spark, sf, "lex_senses").groupBy("lang", "lemma_id", "sense_id").agg(F.max("sense_num").alias("label"))
    lv = F.when(c("label").rlike("^[IVX]+$"), 0).when(c("label").rlike("^[A-Z]$"), 1).when(c("label").rlike("^[0-9]+$"), 2).when(c("label").isNotNull(), 3)
    return s.withColumn("lv", lv)


@query(f"""SELECT lang, lemma_id, sense_id, (SELECT max(b.sense_id) FROM {_LEVELS} b WHERE b.lang IS NOT DISTINCT FROM a.lang AND b.lemma_id IS NOT DISTINCT FROM a.lemma_id AND b.sense_id < a.sense_id AND b.lv < a.lv) AS parent FROM {_LEVELS} a WHERE a.lv IS NOT NULL""")
def w6_nearest_shallower(spark, sf):
    s = _leveled(spark, sf).where("lv is not null")
    return windows.nearest_shallower(s, ["lang", "lemma_id"], "sense_id", c("lv"), "sense_id", 4, "parent").select("lang", "lemma_id", "sense_id", "parent")


@query(r"""SELECT doc_id, pos - 1 AS token_index, tok AS surf_form FROM (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]') AS t FROM documents))""")
def w7_c1_token_index(spark, sf):
    t = F.regexp_extract_all("text", lit(r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]"), lit(0))
    return table(spark, sf, "documents").select("doc_id", F.posexplode(t).alias("token_index", "surf_form"))


@query()
def w8_outline_labels(spark, sf):
    s = _leveled(spark, sf).where("lv is not null").withColumn("level", c("lv") + 1)
    return windows.outline_labels(s, ["lang", "lemma_id"], "sense_id", "level", "label", "outline")


@query("""SELECT global_index, global_index - ((global_index > 20214)::INT + (global_index > 77575)::INT + (global_index > 78758)::INT + (global_index > 98366)::INT + (global_index > 99905)::INT) AS shifted FROM lsj_part18_flat_01""")
def w9_shifted_ids(spark, sf):
    return table(spark, sf, "lsj_part18_flat_01").select("global_index", windows.shifted_id(c("global_index")).alias("shifted"))


@query("""SELECT lang, lemma_id, sense_id, row_number() OVER (PARTITION BY lang, lemma_id ORDER BY sense_id) = 1 AND g IS NULL AS promoted FROM (SELECT s.lang, s.lemma_id, s.sense_id, any_value(m.gloss) AS g FROM (SELECT DISTINCT lang, lemma_id, sense_id FROM lex_senses) s
LEFT JOIN (SELECT lang, lemma_id, max(gloss) AS gloss FROM lex_master GROUP BY ALL) m ON s.lang = m.lang AND s.lemma_id = m.lemma_id GROUP BY ALL)""")
def w10_promote_first_sense(spark, sf):
    s = table(spark, sf, "lex_senses").select("lang", "lemma_id", "sense_id").distinct()
    m = table(spark, sf, "lex_master").groupBy("lang", "lemma_id").agg(F.max("gloss").alias("g"))
    return windows.promote_first(s.join(m, ["lang", "lemma_id"], "left"), ["lang", "lemma_id"], "sense_id", "g").select("lang", "lemma_id", "sense_id", "promoted")


@query("""SELECT lang, lemma_id, last_value(page_num IGNORE NULLS) OVER (PARTITION BY lang ORDER BY lemma_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS page_start, page_num AS page_inside FROM (SELECT lang, lemma_id, max(page_num) AS page_num FROM lex_master GROUP BY ALL)""")
def w11_w12_page_carry(spark, sf):
    m = table(spark, sf, "lex_master").groupBy("lang", "lemma_id").agg(F.max("page_num").alias("page_num"))
    carried = windows.fill_forward(m, "page_num", ["lang"], "lemma_id", "page_start", inclusive=False)
    return carried.select("lang", "lemma_id", "page_start", c("page_num").alias("page_inside"))


# ------------------------------------------------------------------ matching and scoring


def _pairs(spark, sf):
    r = table(spark, sf, "lex_ref_link").where("lang = 'ON'").select(c("lex_ref_link_id").alias("parsed_id"), text.fold_key(c("reflex")).alias("k"), "gloss_eng").distinct()
    m = table(spark, sf, "lex_master").where("lang = 'ON'").select(c("lemma_id").alias("master_id"), text.fold_key(c("lemma")).alias("k"), "gloss").distinct()
    return r.join(m, "k", "left").select("parsed_id", "master_id", "gloss_eng", "gloss")


_PAIRS = f"""(SELECT r.lex_ref_link_id AS parsed_id, m.lemma_id AS master_id, r.gloss_eng, m.gloss FROM (SELECT DISTINCT lex_ref_link_id, {KEY.format('reflex')} AS k, gloss_eng FROM lex_ref_link WHERE lang = 'ON') r
LEFT JOIN (SELECT DISTINCT lemma_id, {KEY.format('lemma')} AS k, gloss FROM lex_master WHERE lang = 'ON') m ON r.k = m.k)"""
_EXACT = "coalesce(master_id IS NOT NULL AND regexp_replace(gloss_eng, ' +', ' ', 'g') = regexp_replace(gloss, '^[0-9]+\\. +?', ''), false)"


@query(f"""SELECT parsed_id, master_id, master_paired, CASE WHEN master_id IS NULL THEN 'none' WHEN ex THEN 'exact' WHEN p_ex THEN 'superseded' WHEN n > 1 THEN 'multiple' WHEN master_paired THEN 'repeat' ELSE 'single' END AS status
FROM (SELECT *, max(ex) OVER (PARTITION BY parsed_id) AS p_ex, count(*) OVER (PARTITION BY parsed_id) AS n, CASE WHEN master_id IS NULL THEN false ELSE max(ex) OVER (PARTITION BY master_id) END AS master_paired FROM (SELECT *, {_EXACT} AS ex FROM {_PAIRS}))""")
def k1_k2_five_way_status(spark, sf):
    return match.five_way(_pairs(spark, sf), "parsed_id", "master_id", match.exact_entry(c("gloss_eng"), c("gloss"))).select("parsed_id", "master_id", "master_paired", "status")


@query(f"""WITH e AS (SELECT DISTINCT parsed_id, master_id FROM {_PAIRS} WHERE {_EXACT}), bad AS (SELECT parsed_id FROM (SELECT parsed_id, count(*) OVER (PARTITION BY master_id) AS n FROM e) WHERE n > 1)
SELECT parsed_id, master_id FROM e WHERE parsed_id NOT IN (SELECT parsed_id FROM bad)""")
def k3_k15_approved_one_to_one(spark, sf):
    exact = _pairs(spark, sf).where(c("master_id").isNotNull() & match.exact_entry(c("gloss_eng"), c("gloss"))).select("parsed_id", "master_id").distinct()
    return match.approved_one_to_one(exact, "parsed_id", "master_id")[0].select("parsed_id", "master_id")


@query(f"""SELECT parsed_id, master_id, length(regexp_replace(gloss_eng, ' +', ' ', 'g')) > 1 AND starts_with(gloss, regexp_replace(gloss_eng, ' +', ' ', 'g')) AS is_prefix FROM {_PAIRS} WHERE gloss IS NOT NULL AND gloss_eng IS NOT NULL""")
def k4_prefix_match(spark, sf):
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null")
    return p.select("parsed_id", "master_id", match.prefix_entry(c("gloss_eng"), c("gloss")).alias("is_prefix"))


@query(f"""SELECT parsed_id, master_id, {_SIM} AS score FROM (SELECT *, {_ASCII.format('gloss_eng')} AS a, {_ASCII.format('gloss')} AS b FROM {_PAIRS}) WHERE gloss IS NOT NULL AND gloss_eng IS NOT NULL""")
def k10_similarity(spark, sf):
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null")
    return p.select("parsed_id", "master_id", F.round(match.similarity(_ascii("gloss_eng"), _ascii("gloss")), 4).alias("score"))


@query(f"""WITH s AS (SELECT parsed_id, master_id, {_SIM} AS score, {_EXACT} AS paired FROM (SELECT *, {_ASCII.format('gloss_eng')} AS a, {_ASCII.format('gloss')} AS b FROM {_PAIRS}) WHERE gloss IS NOT NULL AND gloss_eng IS NOT NULL), t AS (SELECT *, max(score) OVER (PARTITION BY parsed_id) AS top FROM s)
SELECT parsed_id, master_id, CASE WHEN top > 85 AND score = top THEN CASE WHEN paired THEN 'duplicate' ELSE 'approved' END WHEN top > 85 THEN 'dropped' WHEN top > 60 THEN 'review' ELSE 'unmatched' END AS route FROM t""")
def k11_k12_route_by_group(spark, sf):
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null").withColumn("score", F.round(match.similarity(_ascii("gloss_eng"), _ascii("gloss")), 4))
    paired = F.coalesce(match.exact_entry(c("gloss_eng"), c("gloss")), lit(False))
    return match.route_by_group(p, ["parsed_id"], c("score"), paired).select("parsed_id", "master_id", "route")


@query("""WITH d AS (SELECT DISTINCT lex_ref_link_id AS parsed_id, lemma_id AS master_id FROM temp_on_matching), v AS (SELECT *, CASE WHEN master_id % 3 = 0 THEN 'approve' WHEN master_id % 3 = 1 THEN 'reject' END AS verdict FROM d), f AS (SELECT *, min(CASE WHEN verdict = 'approve' THEN master_id END) OVER (PARTITION BY parsed_id) AS won FROM v)
SELECT parsed_id, master_id, CASE WHEN master_id = won THEN 'approved' WHEN won IS NOT NULL THEN 'dropped' WHEN verdict = 'reject' THEN 'rejected' ELSE 'remaining' END AS outcome FROM f""")
def k14_decisions(spark, sf):
    d = table(spark, sf, "temp_on_matching").select(c("lex_ref_link_id").alias("parsed_id"), c("lemma_id").alias("master_id")).distinct()
    verdicts = d.withColumn("verdict", F.when(c("master_id") % 3 == 0, "approve").when(c("master_id") % 3 == 1, "reject"))
    return match.apply_decisions(d, verdicts, "parsed_id", "master_id", "master_id").select("parsed_id", "master_id", "outcome")


@query("""WITH k AS (SELECT lemma_id, row_number() OVER (ORDER BY lemma_id) + 500000 AS new_id FROM (SELECT DISTINCT lemma_id FROM lex_master WHERE lang = 'Skt.')) SELECT s.sense_id, 'see ' || coalesce(CAST(k.new_id AS VARCHAR), '*' || s.lemma_id) || ' above' AS note FROM lex_senses s LEFT JOIN k ON s.lemma_id = k.lemma_id WHERE s.lang = 'Skt.'""")
def k18_substitute_ids(spark, sf):
    ids = table(spark, sf, "lex_master").where("lang = 'Skt.'").select("lemma_id").distinct()
    mapping = windows.global_row_number(ids, [c("lemma_id")], "new_id", 500_000).select(F.concat(lit("*"), c("lemma_id").cast("string")).alias("parsed"), "new_id")
    s = table(spark, sf, "lex_senses").where("lang = 'Skt.'").select("sense_id", F.concat(lit("see *"), c("lemma_id").cast("string"), lit(" above")).alias("note"))
    return match.substitute_ids(s, "note", mapping, "parsed", "new_id", strict=False)


# letters of the list's language read in the wrong encoding, which SQL has to list
_MENDED = "replace(replace(replace(replace(replace({}, 'Ã¤', 'ä'), 'Ã¶', 'ö'), 'Ã¼', 'ü'), 'Ã' || chr(159), 'ß'), 'Ã©', 'é')"
_LOOKUP = "(SELECT trim(unnest(string_split(source_abbrev, ','))) AS token, eng_abbrev AS code FROM lang_abbrev_master)"


@query(rf"""WITH lk AS (SELECT key, rtrim(key, '.') AS bare, min(code) AS code FROM (SELECT lower(regexp_replace(trim(token), '\s+', ' ', 'g')) AS key, code FROM {_LOOKUP}) WHERE key <> '' GROUP BY 1),
v AS (SELECT DISTINCT orig_lang_abbrev AS v, nfc_normalize({_MENDED.format("replace(trim(trim(trim(coalesce(orig_lang_abbrev, '')), chr(34)), chr(39)), chr(160), ' ')")}) AS raw FROM lex_ref_link WHERE orig_lang_abbrev IS NOT NULL),
p AS (SELECT v, list_filter(regexp_split_to_array(regexp_replace(raw, '[()\[\]{{}}]', ' ', 'g'), '[;,/]|\s+'), lambda x: x <> '') AS parts FROM v),
q AS (SELECT DISTINCT v, unnest(CASE WHEN len(parts) = 1 AND contains(parts[1], '-') THEN list_filter(string_split(parts[1], '-'), lambda x: x <> '') ELSE parts END) AS token FROM p),
t AS (SELECT v, token, lower(regexp_replace(trim(token), '\s+', ' ', 'g')) AS own FROM (SELECT v, token FROM q UNION SELECT v, raw FROM v)),
h AS (SELECT t.v, t.token, arg_min(lk.code, (CASE WHEN lk.key = t.own THEN 0 WHEN lk.key = lk.bare || '.' THEN 1 ELSE 2 END, lk.code)) AS code FROM t JOIN lk ON rtrim(t.own, '.') = lk.bare AND lk.key IN (t.own, lk.bare || '.', lk.bare) GROUP BY ALL),
a AS (SELECT v, min(code) AS code, count(DISTINCT code) AS n FROM q JOIN h USING (v, token) GROUP BY 1)
SELECT v.v AS orig_lang_abbrev, CASE WHEN raw = '' THEN NULL ELSE coalesce(d.code, CASE WHEN a.n = 1 THEN a.code END) END AS mapped, CASE WHEN raw = '' THEN 'empty' WHEN d.code IS NOT NULL OR a.n = 1 THEN '' WHEN a.n IS NULL THEN 'unmapped' ELSE 'conflict' END AS status
FROM v LEFT JOIN h d ON v.v = d.v AND v.raw = d.token LEFT JOIN a ON v.v = a.v""")
def k20_t17_t18_abbreviation_cascade(spark, sf):
    lookup = table(spark, sf, "lang_abbrev_master").select(F.explode(F.split("source_abbrev", ",")).alias("token"), c("eng_abbrev").alias("code"))
    return match.resolve_abbreviation(table(spark, sf, "lex_ref_link").where("orig_lang_abbrev is not null").select("orig_lang_abbrev"), "orig_lang_abbrev", lookup)


# ------------------------------------------------------------------ strings, numbers, dates


@query("""SELECT lang, lemma_id, translate(lemma, 'vj', 'ui') AS folded FROM lex_master""")
def t1_letter_folding(spark, sf):
    return table(spark, sf, "lex_master").select("lang", "lemma_id", text.latin_letters(c("lemma")).alias("folded"))


@query("""SELECT lex_ref_link_id, trim(regexp_replace(regexp_replace(regexp_replace(reflex, '[-()*]', '', 'g'), '[0-9]', '', 'g'), ' +', ' ', 'g'), ' ') AS bare FROM lex_ref_link""")
def t2_regexp_replace(spark, sf):
    bare = text.squeeze(F.regexp_replace(F.regexp_replace("reflex", "[-()*]", ""), "[0-9]", ""))
    return table(spark, sf, "lex_ref_link").select("lex_ref_link_id", bare.alias("bare"))


@query(r"""SELECT doc_id, nullif(regexp_extract(text, '[\p{L}\p{M}\p{N}_]+'), '') AS first_word, len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+')) AS n_words FROM documents""")
def t3_first_word(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.first_word(c("text")).alias("first_word"), F.size(text.all_words(c("text"))).cast("long").alias("n_words"))


@query("""SELECT lang, lemma_id, CASE WHEN instr(entry_str, ', ') > 0 THEN left(entry_str, instr(entry_str, ', ') - 1) ELSE '' END AS head, right(entry_str, 5) AS tail, instr(entry_str, ';') AS first_mark, length(entry_str) AS n_chars FROM lex_master WHERE entry_str IS NOT NULL""")
def t4_t5_substrings(spark, sf):
    e = c("entry_str")
    return table(spark, sf, "lex_master").where(e.isNotNull()).select("lang", "lemma_id", text.before(e, ", ").alias("head"), F.right(e, lit(5)).alias("tail"), F.locate(";", e).cast("long").alias("first_mark"), F.length(e).cast("long").alias("n_chars"))


@query("""SELECT lang, lemma_id, CASE WHEN p LIKE 'n.%' THEN 'n.' ELSE p END AS pos_part, CASE WHEN p LIKE 'n.%' THEN nullif(trim(substring(p, 3)), '') END AS gender_part FROM (SELECT lang, lemma_id, concat_ws(' ', pos, gender) AS p FROM lex_master WHERE pos IS NOT NULL)""")
def t6_pos_gender_split(spark, sf):
    m = table(spark, sf, "lex_master").where("pos is not null").select("lang", "lemma_id", F.concat_ws(" ", "pos", "gender").alias("p"))
    pos, gender = text.noun_gender(c("p"))
    return m.select("lang", "lemma_id", pos.alias("pos_part"), gender.alias("gender_part"))


@query("""SELECT lex_ref_link_id, nfc_normalize(reflex) AS nfc FROM lex_ref_link WHERE reflex IS NOT NULL""")
def t7_nfc(spark, sf):
    return table(spark, sf, "lex_ref_link").where("reflex is not null").select("lex_ref_link_id", text.nfc("reflex").alias("nfc"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, ' ([,.;:)\]])', '\1', 'g'), '([(\[]) ', '\1', 'g'), '([,;:])', '\1 ', 'g'), '([)\]])([(\[])', '\1 \2', 'g'), ' +', ' ', 'g') AS spaced FROM documents""")
def t10_punctuation_spacing(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.punctuation_spacing(c("text")).alias("spaced"))


@query("""SELECT lang, lemma_id, repeat('[', greatest(len(g) - len(replace(g, ']', '')) - (len(g) - len(replace(g, '[', ''))), 0)) || g || repeat(']', greatest(len(g) - len(replace(g, '[', '')) - (len(g) - len(replace(g, ']', ''))), 0)) AS balanced
FROM (SELECT lang, lemma_id, repeat('(', greatest(len(g) - len(replace(g, ')', '')) - (len(g) - len(replace(g, '(', ''))), 0)) || g || repeat(')', greatest(len(g) - len(replace(g, '(', '')) - (len(g) - len(replace(g, ')', ''))), 0)) AS g
FROM (SELECT lang, lemma_id, trim(gloss, ' ,;:') AS g FROM lex_master WHERE gloss IS NOT NULL))""")
def t11_balanced_brackets(spark, sf):
    return table(spark, sf, "lex_master").where("gloss is not null").select("lang", "lemma_id", text.balanced(c("gloss")).alias("balanced"))


@query(r"""SELECT lex_ref_link_id, regexp_replace(reflex, '\d+$', '') AS form, TRY_CAST(nullif(regexp_extract(reflex, '(\d+)$', 1), '') AS INT) AS number FROM lex_ref_link""")
def t12_homonym_number(spark, sf):
    form, number = text.homonym(c("reflex"))
    return table(spark, sf, "lex_ref_link").select("lex_ref_link_id", form.alias("form"), number.alias("number"))


@query("""SELECT lex_ref_link_id, lemma_id, regexp_replace(reflex, '[̀-̂]', '', 'g') = regexp_replace(lemma, '[̀-̂]', '', 'g') AS same FROM temp_on_matching""")
def t13_pitch_insensitive(spark, sf):
    return table(spark, sf, "temp_on_matching").select("lex_ref_link_id", "lemma_id", (text.without_pitch(c("reflex")) == text.without_pitch(c("lemma"))).alias("same"))


@query("""SELECT lang, lemma_id, replace(replace(replace(replace(replace(entry, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&') AS entry FROM lex_master WHERE entry IS NOT NULL""")
def t14_unescape(spark, sf):
    return table(spark, sf, "lex_master").where("entry is not null").select("lang", "lemma_id", text.unescape("entry").alias("entry"))


@query("""SELECT lemma_id, lemma, replace(replace(replace(regexp_replace(translate(lower(lemma), 'áýðúéóöøí ', 'aydueoooi-'), '-$', ''), 'þ', 'th'), 'æ', 'ae'), 'œ', 'oe') AS slug FROM lex_master WHERE lang = 'ON'""")
def t15_slug(spark, sf):
    return table(spark, sf, "lex_master").where("lang = 'ON'").select("lemma_id", "lemma", text.slug(c("lemma")).alias("slug"))


@query(f"""SELECT orig_lang_abbrev_raw, {_MENDED.format('orig_lang_abbrev_raw')} AS repaired FROM unmapped_summary""")
def t16_mojibake(spark, sf):
    u = table(spark, sf, "unmapped_summary")
    return u.select("orig_lang_abbrev_raw", text.repair_mojibake(c("orig_lang_abbrev_raw")).alias("repaired"))


@query("""SELECT lang, lemma_id, regexp_replace(entry, '<[^>]*>', '', 'g') AS plain, '<div class="' || lang || ' bodytext">' || entry_str || '</div>' AS body FROM lex_master WHERE entry IS NOT NULL""")
def t19_t20_tags(spark, sf):
    return table(spark, sf, "lex_master").where("entry is not null").select("lang", "lemma_id", text.strip_tags(c("entry")).alias("plain"), text.body_text(c("lang"), c("entry_str")).alias("body"))


@query("""SELECT doc_id, CASE WHEN length(text) > 400 THEN left(text, 400) || ' …' ELSE text END AS short FROM documents""")
def t23_shortened(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.shortened(c("text")).alias("short"))


@query(r"""SELECT doc_id, CASE WHEN contains(lower(text), 'interjection') THEN 'interj.' WHEN contains(lower(text), 'prefix') THEN 'pref.' WHEN contains(lower(text), 'particle') THEN 'part.'
WHEN regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])cl\.\s*\d') OR regexp_matches(text, '(^|[^\p{L}\p{N}_])(P|Ā|U)\.') THEN 'v.' ELSE '' END AS pos_guess FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def t25_pos_heuristics(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.pos_from_text(c("text")).alias("pos_guess"))


@query("""SELECT lex_ref_link_id, TRY_CAST(nullif(rt_master_id, '') AS INT) AS root, TRY_CAST(questionable AS INT) AS flag, coalesce(TRY_CAST(questionable AS INT), 0) AS safe FROM lex_ref_link""")
def n1_n2_n6_casts(spark, sf):
    return table(spark, sf, "lex_ref_link").select("lex_ref_link_id", F.nullif("rt_master_id", lit("")).try_cast("int").alias("root"), c("questionable").try_cast("int").alias("flag"), F.coalesce(c("questionable").try_cast("int"), lit(0)).alias("safe"))


@query("""SELECT lang, lemma_id, written, epoch(try_strptime(written, '%m_%d_%Y_%H%M'))::BIGINT AS stamp FROM (SELECT lang, lemma_id, lpad(CAST(lemma_id % 14 AS VARCHAR), 2, '0') || '_' || lpad(CAST(lemma_id % 33 AS VARCHAR), 2, '0') || '_' || CAST(1990 + lemma_id % 40 AS VARCHAR) || '_' || lpad(CAST(lemma_id % 26 AS VARCHAR), 2, '0') || lpad(CAST(lemma_id % 62 AS VARCHAR), 2, '0') AS written FROM lex_master WHERE lemma_id >= 0)""")
def n3_date_parse(spark, sf):
    part = lambda k, plus=0: F.lpad(((c("lemma_id") % k) + plus).cast("string"), 4 if plus else 2, "0")
    written = F.concat(part(14), lit("_"), part(33), lit("_"), part(40, 1990), lit("_"), part(26), part(62))
    m = table(spark, sf, "lex_master").where("lemma_id >= 0").select("lang", "lemma_id", written.alias("written"))
    return m.withColumn("stamp", F.unix_timestamp(F.try_to_timestamp("written", lit("MM_dd_yyyy_HHmm"))))


# ------------------------------------------------------------------ JSON, corpus, star schema


@query("""WITH s AS (SELECT lang, lemma_id, sense_id, min(gloss) AS gloss FROM lex_senses WHERE lang IS NOT NULL AND lemma_id IS NOT NULL AND gloss IS NOT NULL GROUP BY ALL),
e AS (SELECT lang, lemma_id, min(lemma) AS lemma, min(pos) AS pos FROM lex_master WHERE lang IS NOT NULL GROUP BY ALL), n AS (SELECT *, row_number() OVER (ORDER BY lang, lemma_id) AS entry_no FROM e)
SELECT n.entry_no AS lemma_id, n.lang, n.lemma, CASE WHEN coalesce(s.k, 0) = 0 THEN 'main' ELSE 'sense' END AS row_type, CASE WHEN coalesce(s.k, 0) = 0 THEN n.pos END AS pos, s.gloss, s.gloss AS entry_str, CAST(coalesce(s.k, 0) AS INT) AS sense_at
FROM n LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY lang, lemma_id ORDER BY sense_id) - 1 AS k FROM s) s ON s.lang = n.lang AND s.lemma_id = n.lemma_id""")
def m23_m24_m25_json_entries(spark, sf):
    s = table(spark, sf, "lex_senses").where("lang is not null and lemma_id is not null and gloss is not null").groupBy("lang", "lemma_id", "sense_id").agg(F.min("gloss").alias("gloss"))
    lists = s.groupBy("lang", "lemma_id").agg(F.array_sort(F.collect_list(F.struct("sense_id", "gloss"))).alias("l"))
    e = table(spark, sf, "lex_master").where("lang is not null").groupBy("lang", "lemma_id").agg(F.min("lemma").alias("lemma"), F.min("pos").alias("pos"))
    senses = F.transform("l", lambda x: F.struct(F.array(x["gloss"]).alias("glosses")))
    records = e.join(lists, ["lang", "lemma_id"], "left").select(
        F.struct("lang", "lemma_id").alias("o"), F.to_json(F.struct(c("lemma").alias("word"), c("lang").alias("lang_code"), "pos", senses.alias("senses"))).alias("line")
    )
    parsed = records.select("o", F.from_json("line", dictionary.JSON_RECORD).alias("r")).select("o", "r.*")
    return dictionary.json_entries(parsed, "o").select("lemma_id", "lang", "lemma", "row_type", "pos", "gloss", "entry_str", "sense_at")


@query("""SELECT lang AS file, max(CASE WHEN first THEN page_num END) IS NOT NULL AS has_book, max(CASE WHEN first THEN chapter END) IS NOT NULL AS has_chapter FROM (SELECT *, lemma_id = min(lemma_id) OVER (PARTITION BY lang) AS first FROM (SELECT lang, lemma_id, page_num, CASE WHEN lemma_id % 2 = 0 THEN gloss END AS chapter FROM lex_master WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang, lemma_id ORDER BY page_num NULLS FIRST, gloss NULLS FIRST) = 1)) GROUP BY 1""")
def c5_layout_of_first_line(spark, sf):
    m = table(spark, sf, "lex_master").where("lang is not null").groupBy(c("lang").alias("file"), c("lemma_id").alias("seq")).agg(F.min(F.struct("page_num", "gloss")).alias("s"))
    return corpus.layout(m.select("file", "seq", c("s.page_num").alias("book"), F.when(c("seq") % 2 == 0, c("s.gloss")).alias("chapter")))


@query(r"""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '“”', '  '), '[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]')) AS tok FROM documents) WHERE tok = 'root' GROUP BY 1""")
def c9_lookup_form(spark, sf):
    return corpus.lookup_form(_tokens(spark, sf), "root").groupBy("doc_id").agg(F.count(lit(1)).alias("n"))


@query(r"""SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS w FROM documents) GROUP BY 1""")
def base_word_counts(spark, sf):
    return table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), lit(r"[\p{L}\p{M}]+"), lit(0))).alias("w")).groupBy("w").agg(F.count(lit(1)).alias("n"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def base_pricing_summary(spark, sf):
    li = table(spark, sf, "lineitem").where(c("l_shipdate") <= lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2).alias("sum_disc_price"), F.count(lit(1)).alias("n"))


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def base_nation_revenue(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = li.join(o, c("l_orderkey") == c("o_orderkey")).join(cu, c("o_custkey") == c("c_custkey")).join(F.broadcast(n), c("c_nationkey") == c("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2).alias("revenue"))


# ------------------------------------------------------------------ scripts, markup, corpora: no SQL can say these


@query(rf"""SELECT parsed_id, master_id, length(rest) > 1 AND ends_with(gloss, rest) AS is_suffix FROM (SELECT *, regexp_replace(regexp_replace(gloss_eng, '^(?:.*?[\x{{0900}}-\x{{097F}}\x{{0980}}-\x{{09FF}}\x{{A8E0}}-\x{{A8FF}}]\)){{1,4}} *(?:[mfn]{{1,3}}\.)', ''), ' +', ' ', 'g') AS rest FROM {_PAIRS}) WHERE gloss IS NOT NULL AND gloss_eng IS NOT NULL""")
def k5_k13_suffix_match(spark, sf):
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null")
    return p.select("parsed_id", "master_id", match.suffix_entry(c("gloss_eng"), c("gloss")).alias("is_suffix"))


@query()
def k6_k9_transliteration_route(spark, sf):
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null").withColumn("r", transliteration_match.routed(c("gloss_eng"), c("gloss")))
    return p.select("parsed_id", "master_id", "r.route", "r.score")


@query(r"""SELECT o.lex_ref_link_id, s.lemma, m.lang, m.lemma_id FROM (SELECT lex_ref_link_id FROM lex_ref_link WHERE word_id IS NULL) o
JOIN (SELECT lex_ref_link_id, regexp_replace(reflex, '[-0-9*]', '', 'g') AS lemma FROM lex_ref_link WHERE word_id IS NULL AND reflex IS NOT NULL) s ON o.lex_ref_link_id = s.lex_ref_link_id JOIN lex_master m ON m.lemma = s.lemma WHERE m.lemma_id IS NOT NULL""")
def k19_second_chance(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma", "lemma_id")
    stems = table(spark, sf, "lex_ref_link").where("word_id is null and reflex is not null").select("lex_ref_link_id", F.regexp_replace("reflex", r"[-0-9*]", "").alias("lemma"))
    open_ = table(spark, sf, "lex_ref_link").where("word_id is null").select("lex_ref_link_id")
    return corpus.second_chance(open_, stems, m, "lex_ref_link_id").where("lemma_id is not null")


@query()
def x2_x4_scripts(spark, sf):
    m = table(spark, sf, "lex_master").where("lang = 'Skt.' and lemma is not null")
    slp = translit.to_slp1("lemma")
    return m.select("lemma_id", "lemma", translit.roman_to_deva("lemma").alias("native"), slp.alias("one_letter"), translit.to_iast(slp).alias("round_trip"))


@query()
def x8_greek_to_roman(spark, sf):
    return table(spark, sf, "lex_master").where("lang = 'Gk.' and lemma is not null").select("lemma_id", "lemma", translit.romanize_greek("lemma").alias("roman"))


@query()
def x11_x13_symbols(spark, sf):
    r = table(spark, sf, "rt_ref_link").select("rt_ref_link_id", F.regexp_replace("rt_shape", "-$", "").alias("shape"))
    target = translit.target_symbol(c("shape"))
    return r.select("rt_ref_link_id", target.alias("target"), translit.available(target).alias("modifiers"), translit.modify("shape", lit("macron")).alias("modified"))


@query()
def x14_symbol_families(spark, sf):
    letters = F.array_distinct(F.filter(F.split("lemma", ""), lambda x: x != ""))
    fam = table(spark, sf, "lex_master").where("lemma is not null").select("lang", "lemma_id", F.substring("lemma", 1, 1).alias("b"), letters.alias("v"))
    return translit.merged_families(fam, "b", "v", ["lang", "lemma_id"])


@query()
def m17_m20_entry_html(spark, sf):
    m = table(spark, sf, "lex_master").where("entry is not null")
    return m.select("lang", "lemma_id", markup.to_html("oldnorse")("entry").alias("html"))


@query()
def m22_flat_records(spark, sf):
    m = table(spark, sf, "lex_master").where("entry is not null").select("lang", "lemma_id", "entry")
    flat = markup.flatten_records(m, "entry", ["lang", "lemma_id"])
    lists = ("sense", "tr", "etym", "cit", "xref")
    return markup.with_pages(flat, ["lang"], "lemma_id").select(
        "lang", "lemma_id", "headword", "pos", "gender", "page_start", "page_end", *[f"{k}_count" for k in lists], *[f"has_{k}" for k in lists],
        *[f"{k}_json" for k in ("senses", "translations", "etymologies", "citations", "biblio", "gramgrp", "xrefs")],
    )


def _tokens(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    return corpus.tokenize(lines, "doc_id", "seq", "text")


@query(r"""SELECT doc_id, count(*) AS n_tokens FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '“”', '  '), '[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]')) AS tok FROM documents) GROUP BY 1""")
def c1_c4_document_tokens(spark, sf):
    return _tokens(spark, sf).groupBy("doc_id").agg(F.count(lit(1)).alias("n_tokens"))


@query()
def snk6_section_json(spark, sf):
    t = _tokens(spark, sf).select(c("doc_id").alias("doc"), lit("1").alias("book"), lit(None).cast("string").alias("chapter"), c("seq").cast("string").alias("line_num"), "doc_token_index", "token", "pos")
    return sinks.section_json(t)


@query(r"""SELECT doc_id, pos - 1 AS line, count(*) AS n_tokens FROM (SELECT doc_id, pos, unnest(regexp_extract_all(translate(l, '“”', '  '), '[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]')) AS tok FROM (SELECT doc_id, unnest(a) AS l, generate_subscripts(a, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))) GROUP BY ALL""")
def c3_tokens_to_lines(spark, sf):
    """Tokens numbered through the document, as an annotator gives them, found again in their lines."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    t = corpus.tokenize(lines, "doc_id", "seq", "text").select("doc_id", "doc_token_index", "token")
    aligned = corpus.align_tokens(lines, t, "doc_id", "seq", "text", "doc_token_index", "token")
    return aligned.groupBy("doc_id", "line").agg(F.count(lit(1)).alias("n_tokens"))


@query(r"""WITH n AS (SELECT lang, lemma_id, max(lemma) AS lemma FROM lex_master WHERE lemma IS NOT NULL AND NOT regexp_matches(lemma, '[<>\n]') GROUP BY ALL)
SELECT lang, lemma_id, k.place AS sense_at, k.label, CAST(lemma_id AS VARCHAR) || '.' || k.place AS h_number, CASE WHEN k.up > 0 THEN lemma_id || '.' || k.up END AS parent_h_number
FROM n, (VALUES (1, 'I', 0), (2, '1', 1), (3, 'a', 2), (4, 'b', 2), (5, '2', 1), (6, 'II', 0), (7, 'c', 6)) k(place, label, up)""")
def m13_m14_m15_line_senses(spark, sf):
    """Lines with numbered senses of three levels scanned to trees."""
    m = table(spark, sf, "lex_master").where("lemma is not null").where(~c("lemma").rlike(r"[<>\n]")).groupBy("lang", "lemma_id").agg(F.max("lemma").alias("lemma"))
    body = " <I>n. x</I> I. one 1. two a. three b. four 2. five II. six c. seven"
    lines = m.select("lang", "lemma_id", F.concat(lit("<B>"), "lemma", lit("</B>" + body)).alias("entry"))
    senses = dictionary.nested_line_senses(dictionary.line_entries(lines).drop("lemma"), ["lang", "lemma_id"])
    return senses.select("lang", "lemma_id", "sense_at", "label", F.regexp_extract("h_number", r"(\d+\.\d+)$", 1).alias("h_number"), F.nullif(F.regexp_extract("parent_h_number", r"(\d+\.\d+)$", 1), lit("")).alias("parent_h_number"))


@query("""SELECT lang, lemma_id, TRY_CAST(sense_num AS INT) AS sense_num, NULL::VARCHAR AS script, 'x' AS editor, TIMESTAMP '2026-01-02 03:04:05' AS last_updated FROM lex_master""")
def snk11_n5_altered_and_stamped(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_id", "sense_num", "gloss", "editor", "last_updated")
    return merge.stamped(merge.altered(m, {"script": "string"}, {"sense_num": "int"}, ["gloss"]), "2026-01-02 03:04:05", "x")


@query("""SELECT CAST(ordinal AS INT) AS ordinal, name FROM (VALUES (1, 'lang'), (2, 'lemma'), (3, 'lemma_translit'), (4, 'lemma_normalized'), (5, 'lemma_id')) t(ordinal, name)""")
def x10_column_order(spark, sf):
    m = table(spark, sf, "lex_master").select("lang", "lemma_normalized", "lemma", "lemma_id", "lemma_translit")
    return readers.column_catalog(merge.moved_behind(m, ["lemma_translit", "lemma_normalized"], "lemma")).select("ordinal", "name")


@query("""SELECT lang, lemma_id, CASE upper(left(pos, 1)) WHEN 'N' THEN 'n.' WHEN 'V' THEN 'v.' WHEN 'A' THEN 'adj.' WHEN 'D' THEN 'adv.' WHEN 'R' THEN 'prep.' WHEN 'C' THEN 'conj.' WHEN 'G' THEN 'conj.' WHEN 'M' THEN 'numer.' WHEN 'T' THEN 'part.' WHEN 'I' THEN 'interj.' WHEN 'E' THEN 'interj.' WHEN 'P' THEN 'pron.' WHEN 'L' THEN 'art.' END AS tagged FROM lex_master""")
def c7_pos_of_tags(spark, sf):
    tags = F.array(lit("---"), F.concat(F.upper("pos"), lit("-s-")))
    return table(spark, sf, "lex_master").select("lang", "lemma_id", corpus.pos_of_tags(tags).alias("tagged"))


@query()
def k12_row_scores(spark, sf):
    """Candidates of a word scored one by one, then routed by the best of their group."""
    p = _pairs(spark, sf).where("gloss is not null and gloss_eng is not null").withColumn("score", transliteration_match.row_score(c("gloss_eng"), c("gloss")))
    return match.route_by_group(p, ["parsed_id"], c("score"), F.coalesce(match.exact_entry(c("gloss_eng"), c("gloss")), lit(False))).select("parsed_id", "master_id", "score", "route")
