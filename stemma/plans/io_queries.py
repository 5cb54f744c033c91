"""Sources and sinks as queries: a table is written in a format, read back by the source of that format, and compared."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import markup, text
from stemma.operators import merge
from stemma.plans.reference_queries import _tokens
from stemma.session import shared_folder, table
from stemma.sources import readers, sinks

QUERIES = {}
ORACLE: dict[str, str] = {}
c, lit = F.col, F.lit


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


_LINKS = ["lex_ref_link_id", "lang", "reflex", "gloss_eng", "page_loc"]


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lex_ref_link").select(*[c(x).cast("string").alias(x) for x in _LINKS])


_LINKS_SQL = "SELECT CAST(lex_ref_link_id AS VARCHAR) AS lex_ref_link_id, " + ", ".join(f"nullif({x}, '') AS {x}" for x in _LINKS[1:]) + " FROM lex_ref_link"


@query(_LINKS_SQL)
def src1_snk1_ordered_csv(spark, sf):
    """Ordered CSV with quotes, separators and line breaks inside fields, read back by position."""
    place = _place(spark)
    sinks.write_csv(_links(spark, sf), place, ["lang", "lex_ref_link_id"])
    return readers.read_csv(spark, place, _LINKS)


@query("""SELECT CAST(lex_ref_link_id AS INT) AS lex_ref_link_id, TRY_CAST(nullif(trim(page_loc), '') AS INT) AS page, try_strptime(strftime(last_updated, '%m_%d_%Y_%H%M'), '%m_%d_%Y_%H%M') AS written FROM lex_ref_link""")
def src2_src3_snk2_typed_csv(spark, sf):
    """Loaded as text, columns left out, the others cast with what does not parse as null."""
    place = _place(spark)
    rows = table(spark, sf, "lex_ref_link").select(c("lex_ref_link_id").cast("string"), "notes", c("page_loc").alias("page"), F.date_format("last_updated", "MM_dd_yyyy_HHmm").alias("written"))
    sinks.write_csv(rows, place)
    read = readers.read_csv(spark, place, ["lex_ref_link_id", "notes", "page", "written"], keep=["lex_ref_link_id", "page", "written"])
    return readers.typed(read, {"lex_ref_link_id": "int", "page": "int"}, {"written": "MM_dd_yyyy_HHmm"})


@query("""SELECT m.lang, m.lemma_id, l.full_language_name AS language FROM lex_master m, lang_abbrev_master l WHERE l.eng_abbrev = 'ON'""")
def src4_constant_from_lookup(spark, sf):
    return readers.with_constant_from(table(spark, sf, "lex_master").select("lang", "lemma_id"), table(spark, sf, "lang_abbrev_master").withColumnRenamed("full_language_name", "language"), "eng_abbrev = 'ON'", "language", "language")


@query("""SELECT CAST(lemma_id AS VARCHAR) AS id, nullif(lemma, '') AS word FROM lex_master UNION ALL SELECT CAST(sense_id AS VARCHAR), nullif(lemma, '') FROM lex_senses""")
def src5_src6_headless_files_appended(spark, sf):
    """Files without header and with names imposed, loaded into one table."""
    places = [_place(spark), _place(spark)]
    for place, (name, key) in zip(places, (("lex_master", "lemma_id"), ("lex_senses", "sense_id"))):
        table(spark, sf, name).select(c(key).cast("string").alias("a"), c("lemma").alias("b")).write.options(quote='"', escape='"', nullValue="\\N", emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(place)
    return readers.append_all([readers.read_csv(spark, place, ["id", "word"], header=False) for place in places])


@query("""SELECT trim(orig_lang_abbrev_raw, ' ') AS c0, CAST(row_count AS VARCHAR) AS c1 FROM unmapped_summary WHERE trim(orig_lang_abbrev_raw) <> '' AND NOT regexp_matches(orig_lang_abbrev_raw, '[\\t\\n\\r]')""")
def src7_ragged_tsv(spark, sf):
    """Raw value and count between one or several tabs."""
    place = _place(spark)
    u = table(spark, sf, "unmapped_summary").where("trim(orig_lang_abbrev_raw) <> ''").where(~c("orig_lang_abbrev_raw").rlike(r"[\t\n\r]"))
    tabs = F.repeat(lit("\t"), (c("row_count") % 3 + 1).cast("int"))
    u.select(F.concat("orig_lang_abbrev_raw", tabs, c("row_count").cast("string"), lit("\t")).alias("value")).write.text(place)
    return readers.read_ragged_tsv(spark, place, 2)


@query("""SELECT lang, lemma_id, lemma, gloss FROM lex_master WHERE lang = 'OE' OR lang = 'ON'""")
def src8_snk5_jsonl(spark, sf):
    place = _place(spark)
    sinks.write_jsonl(table(spark, sf, "lex_master").select("lang", "lemma_id", "lemma", "gloss", c("lang").alias("lang_code")), place)
    return readers.read_jsonl(spark, place, "lang string, lemma_id int, lemma string, gloss string, lang_code string", "OE", "ON").select("lang", "lemma_id", "lemma", "gloss")


@query("""SELECT lemma_id, lemma, gloss FROM lex_master WHERE lang = 'Lat.' AND lemma IS NOT NULL AND NOT regexp_matches(coalesce(gloss, '') || lemma, '[\\n\\r]')""")
def src9_src10_src11_xml_records(spark, sf):
    """Entries as elements of one large file with mixed content and a named entity, cut at their ends and parsed."""
    place = _place(spark)
    m = table(spark, sf, "lex_master").where("lang = 'Lat.' and lemma is not null").where(~F.concat(F.coalesce("gloss", lit("")), "lemma").rlike(r"[\n\r]"))
    safe = lambda x: F.replace(F.replace(F.replace(x, lit("&"), lit("&amp;")), lit("<"), lit("&lt;")), lit(">"), lit("&gt;"))
    tr = F.coalesce(F.concat(lit("<tr>"), safe(c("gloss")), lit("</tr>")), lit(""))
    m.select(F.concat(lit('<entryFree id="'), c("lemma_id").cast("string"), lit('"> <orth>'), safe(c("lemma")), lit("</orth>, "), tr, lit(" &stop;</entryFree>")).alias("value")).coalesce(1).write.text(place)
    records = readers.read_xml_records(spark, place, "entryFree", {"stop": "."})

    @F.pandas_udf("lemma_id int, lemma string, gloss string")
    def fields(record: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_entry(r) for r in record], columns=["lemma_id", "lemma", "gloss"])

    return records.select(fields("record").alias("f")).select("f.*")


def _entry(record: str) -> tuple:
    root = markup.parse(record)
    tr = markup.first(root, "tr")
    return int(root.get("id")), markup.inner_text(markup.first(root, "orth")), None if tr is None else markup.inner_text(tr)


@query("""SELECT page_num AS page, '<B>' || lemma || '</B> more of ' || lemma AS entry FROM lex_master WHERE lang = 'OE' AND page_num IS NOT NULL AND lemma IS NOT NULL AND NOT regexp_matches(lemma, '[\\n\\r]|^ | $')""")
def src12_page_lines(spark, sf):
    """Page marks, bold headwords and lines that continue an entry."""
    place = _place(spark)
    m = table(spark, sf, "lex_master").where("lang = 'OE' and page_num is not null and lemma is not null").where(~c("lemma").rlike(r"[\n\r]|^ | $"))
    lines = F.concat(lit("<PAGE NUM="), c("page_num").cast("string"), lit(">\n<B>"), "lemma", lit("</B>\n more of "), "lemma", lit("\n"))
    m.select(lines.alias("value")).coalesce(1).write.text(place)
    kinds = readers.classify_dictionary_lines(readers.read_lines(spark, place))
    return readers.join_overflow(kinds).select("page", "entry")


@query("""SELECT CAST(global_index AS VARCHAR) AS line_num, '1' AS book, headword AS text FROM lsj_part18_flat_01 WHERE headword IS NOT NULL AND trim(headword) <> '' AND NOT regexp_matches(headword, '[\\n\\r]')""")
def src13_annotated_text(spark, sf):
    place = _place(spark)
    h = table(spark, sf, "lsj_part18_flat_01").where("headword is not null and trim(headword) <> ''").where(~c("headword").rlike(r"[\n\r]"))
    h.select(F.concat(lit("<author. work. 1."), c("global_index").cast("string"), lit("> "), "headword").alias("value")).write.text(place)
    return readers.read_annotated(spark, place).select("line_num", "book", "text")


@query("""SELECT lang, lemma_id, [upper(lang)] AS texts FROM lex_master WHERE lang IS NOT NULL AND NOT regexp_matches(lang, '[&<]')""")
def src15_html_texts(spark, sf):
    m = table(spark, sf, "lex_master").where("lang is not null").where(~c("lang").rlike("[&<]"))
    page = F.concat(lit('<html><body><div class="x">no</div><div class="entry">'), F.upper("lang"), lit("</div></body></html>"))
    return readers.html_text(m.select("lang", "lemma_id", page.alias("page")), "page", "div", "class", "entry").select("lang", "lemma_id", "texts")


@query("""SELECT CAST(lex_ref_link_id AS VARCHAR) AS a, reflex AS b, gloss_eng AS c FROM lex_ref_link""")
def src17_sql_dump(spark, sf):
    """Rows as INSERT statements with quotes, backslashes, semicolons and line breaks inside values."""
    place = _place(spark)
    quoted = lambda x: F.coalesce(F.concat(lit("'"), F.replace(F.replace(F.replace(c(x), lit("\\"), lit("\\\\")), lit("'"), lit("''")), lit("\n"), lit("\\n")), lit("'")), lit("NULL"))
    r = table(spark, sf, "lex_ref_link")
    r.select(F.concat(lit("INSERT INTO t VALUES ("), c("lex_ref_link_id").cast("string"), lit(", "), quoted("reflex"), lit(", "), quoted("gloss_eng"), lit(");")).alias("value")).write.text(place)
    return readers.read_sql_dump(spark, place, ["a", "b", "c"])


@query("""SELECT CAST(column_index AS INT) AS ordinal, column_name AS name FROM duckdb_columns() WHERE table_name = 'temp_on_matching'""")
def src19_column_catalog(spark, sf):
    return readers.column_catalog(table(spark, sf, "temp_on_matching")).select("ordinal", "name")


@query("""SELECT * FROM (VALUES (1, 'Livy', NULL), (2, 'O''Neill', 3.5::DOUBLE)) t(id, name, share)""")
def src20_row_literals(spark, sf):
    return readers.literal_rows(spark, [(1, "Livy", None), (2, "O'Neill", 3.5)], "id int, name string, share double")


@query("""SELECT lang, CAST(lemma_id AS VARCHAR) AS lemma_id, nullif(lemma, '') AS lemma FROM lex_master WHERE lang IS NOT NULL""")
def snk3_routed_files(spark, sf):
    """One folder of files for each language, read back with the language from the folder."""
    place = _place(spark)
    sinks.write_routed(table(spark, sf, "lex_master").where("lang is not null").select("lang", c("lemma_id").cast("string"), "lemma"), place, "lang")
    read = spark.read.options(**{"header": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "multiLine": "true"}).schema("lemma_id string, lemma string, lang string").csv(place)
    return read.select("lang", "lemma_id", F.nullif("lemma", lit("")).alias("lemma"))


@query("""SELECT count(*) AS n_rows, true AS within FROM lex_ref_link""")
def snk4_bounded_files(spark, sf):
    """Files of about 200 kB at most; all rows are there."""
    place = _place(spark)
    sinks.write_bounded(_links(spark, sf), place, 200_000)
    read = spark.read.options(header="true", quote='"', escape='"', nullValue="\\N", multiLine="true").csv(place)
    sizes = spark.read.format("binaryFile").load(place).select("length")
    return read.agg(F.count(lit(1)).alias("n_rows")).crossJoin(sizes.agg((F.max("length") <= 400_000).alias("within")))


@query(r"""SELECT doc_id AS doc, ['1'] AS chapters FROM (SELECT DISTINCT doc_id FROM documents WHERE regexp_matches(text, '[^\s“”]'))""")
def snk7_section_index(spark, sf):
    t = _tokens(spark, sf).select(c("doc_id").alias("doc"), lit("1").alias("book"), lit("1").alias("chapter"), "doc_token_index")
    return sinks.section_index(t).select("doc", "chapters")


@query("""SELECT lang, lemma_id, 'no page' AS error FROM lex_master WHERE page_num IS NULL""")
def snk8_remediation_notices(spark, sf):
    m = table(spark, sf, "lex_master").withColumn("error", F.when(c("page_num").isNull(), "no page"))
    return sinks.remediation_notices(m, "error", ["lang", "lemma_id"])


@query("""SELECT lower(tag) AS tag, CAST(count(*) AS VARCHAR) AS n FROM (SELECT unnest(regexp_extract_all(entry, '<([A-Za-z][A-Za-z0-9]*)', 1)) AS tag FROM lex_master) GROUP BY 1""")
def snk9_tag_profile(spark, sf):
    """Tag counts written in order of frequency and read back."""
    place = _place(spark)
    tags = table(spark, sf, "lex_master").select(F.explode(text.tags(c("entry"))).alias("tag")).groupBy(F.lower("tag").alias("tag")).agg(F.count(lit(1)).alias("n"))
    sinks.write_csv(tags, place, [F.desc("n"), "tag"])
    return readers.read_csv(spark, place, ["tag", "n"])


@query("""SELECT lang, lemma_id, upper(gloss) AS gloss FROM lex_master WHERE lang = 'OE' UNION ALL SELECT lang, lemma_id, gloss FROM lex_master WHERE lang <> 'OE'""")
def u9_staged_overwrite(spark, sf):
    """One slice replaced through a staged version; a second delivery that fails its check changes nothing."""
    place = _place(spark)
    m = table(spark, sf, "lex_master").where("lang is not null").select("lang", "lemma_id", "gloss")
    checks = {"no id": "lemma_id is null"}
    merge.staged_overwrite(spark, place, m, "lang", checks)
    merge.staged_overwrite(spark, place, m.where("lang = 'OE'").withColumn("gloss", F.upper("gloss")), "lang", checks)
    merge.staged_overwrite(spark, place, m.where("lang = 'ON'").withColumn("lemma_id", lit(None).cast("int")), "lang", checks)
    return spark.read.parquet(f"{place}/v{merge.current_version(spark, place)}")
