"""Dictionary records to main and sense rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import markup
from stemma.operators import windows

# ------------------------------------------------------------------ JSON records

JSON_RECORD = (
    "word string, lang string, lang_code string, pos string, forms array<struct<form:string,tags:array<string>>>, "
    "sounds array<struct<ipa:string>>, etymology_text string, senses array<struct<glosses:array<string>,raw_glosses:array<string>,tags:array<string>>>"
)
# fixed values: names of parts of speech and genders in the records
POS_NAMES = {
    "noun": "n.", "name": "n.", "character": "n.", "verb": "v.", "pron": "pron.", "prep": "prep.", "intj": "interj.",
    "conj": "conj.", "adv": "adv.", "adj": "adj.",
}
GENDERS = {"masculine": "m.", "feminine": "f.", "neuter": "n."}


def _named(c, table: dict[str, str]):
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[c], c)


def json_entries(records: DataFrame, order: str) -> DataFrame:
    """Main row for the first sense of a record, sense rows for the others.

    A record whose first sense has no gloss, and no mark that says so, gets ``error``.
    """
    numbered = records if "lemma_id" in records.columns else windows.global_row_number(records, [F.col(order)], "lemma_id")
    tags = F.try_element_at("forms", F.lit(1))["tags"]
    pos = _named(F.col("pos"), POS_NAMES)
    second = F.try_element_at(tags, F.lit(2))
    gender = F.when((pos == "n.") & (F.try_element_at(tags, F.lit(1)) == "canonical") & second.isin(*GENDERS), _named(second, GENDERS))
    base = numbered.select(
        "lemma_id", F.col("lang_code").alias("lang"), F.col("word").alias("lemma"), F.try_element_at("forms", F.lit(1))["form"].alias("orthography"),
        F.try_element_at("sounds", F.lit(1))["ipa"].alias("ipa"), pos.alias("pos"), gender.alias("gender"), F.col("etymology_text").alias("etymology"),
        F.posexplode_outer("senses").alias("sense_at", "s"),
    )
    body = F.array_join(F.coalesce("s.raw_glosses", "s.glosses"), "; ")
    excused = F.coalesce(F.arrays_overlap("s.tags", F.array(F.lit("no-gloss"), F.lit("empty-gloss"))), F.lit(False))
    is_main = F.coalesce(F.col("sense_at"), F.lit(0)) == 0
    only_main = lambda x: F.when(is_main, F.col(x)).alias(x)
    return base.select(
        "lemma_id", "lang", "lemma", F.when(is_main, "main").otherwise("sense").alias("row_type"), only_main("orthography"), only_main("ipa"), only_main("pos"),
        only_main("gender"), only_main("etymology"), F.nullif(body, F.lit("")).alias("entry_str"), F.try_element_at("s.glosses", F.lit(1)).alias("gloss"),
        F.coalesce("sense_at", F.lit(0)).alias("sense_at"), F.when(is_main & F.col("s.glosses").isNull() & ~excused, "no gloss").alias("error"),
    )


# ------------------------------------------------------------------ indented XML entries

ENTRY_ROWS = (
    "definition int, sense_at int, row_type string, lemma string, pos string, gender string, gloss string, entry string, entry_str string, sense_num string, level int"
)


def _entry_rows(record: str) -> list[tuple]:
    root = markup.parse(record)
    lemma = root.get("word")
    rules = markup.RULES["oldnorse"]
    out = []
    definitions = markup.split_definitions(root)
    for d, kids in enumerate(definitions, 1):
        holder = markup.ET.Element("subentry")
        holder.extend(kids)
        pos, gender = markup.pos_and_gender([p.text or "" for p in holder.iter("p")])
        gloss = markup.first_or_child_text(holder)
        senses = []
        for label, level, part in markup.split_senses(kids):
            sense = markup.ET.Element("sense")
            sense.extend(part)
            text = re.sub(r"\n+\t?", "\\\\n", markup.inner_text(sense).rstrip())
            senses.append((label, level, markup.write_html(sense, rules, max(level, 1)), text))
        main_html = main_text = None
        if senses and (not senses[0][0] or len(senses) >= 1):
            _, _, main_html, main_text = senses.pop(0)  # the first sense stands for a blank main part
        number = str(d) if len(definitions) > 1 else None
        out.append((d, 0, "main", lemma, pos, gender, gloss or None, main_html or None, main_text or None, number, 0))
        out += [(d, i, "sense", lemma, None, None, None, h or None, t or None, label, lv) for i, (label, lv, h, t) in enumerate(senses, 1)]
    return out


def indented_entries(records: DataFrame, record: str, keys: list[str]) -> DataFrame:
    """keys and ENTRY_ROWS: one main row per definition and its senses with label and level."""
    names = [c.split()[0] for c in ENTRY_ROWS.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(*k, *r) for *k, x in b[[*keys, record]].itertuples(index=False) for r in _entry_rows(x)]
            yield pd.DataFrame(out, columns=[*keys, *names])

    kinds = ", ".join(f"`{k}` {records.schema[k].dataType.simpleString()}" for k in keys)
    return records.where(F.col(record).isNotNull()).select(*keys, record).mapInPandas(rows, f"{kinds}, {ENTRY_ROWS}")


def with_parents(rows: DataFrame, partition: list[str], order: str, levels: int = 6) -> DataFrame:
    """Add parent_at: place of the nearest shallower sense before; main rows have none."""
    senses = rows.where("row_type = 'sense'")
    main = rows.where("row_type <> 'sense'").withColumn("parent_at", F.lit(None).cast(rows.schema[order].dataType))
    return windows.nearest_shallower(senses, partition, order, F.col("level"), order, levels, "parent_at").unionByName(main)


# ------------------------------------------------------------------ headword trees by root tag


def headword_tree(records: DataFrame, tag: str, order: str, key: str, partition: list[str]) -> DataFrame:
    """Add kind, level and related: the nearest earlier headword of a lower level number."""
    m = F.regexp_extract(tag, r"^H([1-4])([A-E]?)$", 1)
    suffix = F.regexp_extract(tag, r"^H([1-4])([A-E]?)$", 2)
    kind = F.when(m == "", "other").when(suffix == "", "headword").when(suffix == "A", "variant").when(suffix == "E", "extension").otherwise("continuation")
    tagged = records.withColumn("kind", kind).withColumn("level", F.nullif(m, F.lit("")).cast("int"))
    heads = windows.nearest_shallower(tagged.where("kind = 'headword'"), partition, order, F.col("level"), key, 5, "related")
    rest = tagged.where("kind <> 'headword'").withColumn("related", F.lit(None).cast(tagged.schema[key].dataType))
    return heads.unionByName(rest)


def appended_etymologies(records: DataFrame, partition: list[str], order: str, etymology: str, is_head: str) -> DataFrame:
    """(partition, head order, etymology): texts of a head and its continuations, equal ones once, in order."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.expr(is_head), F.col(order)), True).over(w)
    parts = records.withColumn("head", owner).where(F.col(etymology).isNotNull() & F.col("head").isNotNull())
    grouped = parts.groupBy(*partition, "head").agg(F.array_sort(F.collect_list(F.struct(order, etymology))).alias("e"))
    return grouped.select(*partition, "head", F.array_join(F.array_distinct(F.transform("e", lambda x: x[etymology])), " ").alias(etymology))


# ------------------------------------------------------------------ bold-headword lines

# fixed values: parts of speech as the entries write them, longest first
LINE_POS = ("adj.", "adv.", "prep.", "conj.", "pron.", "interj.", "num.", "part.", "v. trans.", "v. intrans.", "v.", "m.", "f.", "n.", "indecl.")


def line_entries(entries: DataFrame, column: str = "entry") -> DataFrame:
    """Add lemma, etymology, pos, gender, gloss and numbered senses of 'B headword /B ... I pos. gloss /I' lines."""
    e = F.regexp_replace(F.regexp_replace(F.col(column), r"<(/?)[Bb]>", "<$1b>"), r"<(/?)[Ii]>", "<$1i>")
    lemma = F.trim(F.regexp_extract(e, r"^\s*<b>(.*?)</b>", 1), F.lit(" ,;:."))
    rest = F.regexp_replace(e, r"^\s*<b>.*?</b>", "")
    etymology = F.nullif(F.regexp_extract(rest, r"\[([^\]]*)\]", 1), F.lit(""))
    italics = F.regexp_extract_all(rest, F.lit(r"<i>(.*?)</i>"), F.lit(1))
    first_i = F.trim(F.coalesce(F.try_element_at(italics, F.lit(1)), F.lit("")))
    pos_pattern = "^(" + "|".join(re.escape(p) for p in sorted(LINE_POS, key=len, reverse=True)) + ")"
    mark = F.nullif(F.regexp_extract(first_i, pos_pattern, 1), F.lit(""))
    is_gender = mark.isin("m.", "f.", "n.")
    gloss = F.trim(F.regexp_replace(first_i, pos_pattern, ""), F.lit(" ,;:."))
    imputed = F.when(gloss.startswith("to "), "v.").when(gloss.rlike(r"^(?:a|an|the) "), "n.")
    plain = F.trim(F.regexp_replace(F.regexp_replace(rest, r"<[^>]*>", ""), r"\s+", " "))
    senses = F.filter(F.split(plain, r"(?:^|\s)(?=(?:[IVX]+|\d{1,2}|[a-eg-lo-u])\.\s)"), lambda x: x.rlike(r"^(?:[IVX]+|\d{1,2}|[a-eg-lo-u])\.\s"))
    return entries.select(
        "*", F.nullif(lemma, F.lit("")).alias("lemma"), etymology.alias("etymology"), F.coalesce(F.when(is_gender, "n.").otherwise(mark), imputed).alias("pos"),
        F.when(is_gender, mark).alias("gender"), F.nullif(gloss, F.lit("")).alias("gloss"), plain.alias("entry_str"),
        F.transform(senses, lambda x: F.struct(F.regexp_extract(x, r"^(\w+)\.", 1).alias("label"), F.regexp_replace(x, r"^\w+\.\s+", "").alias("text"))).alias("senses"),
    )


def sense_level(label):
    """Level of a label: roman, figure, letter; the rest below them."""
    return F.when(label.rlike("^[IVX]+$"), 1).when(label.rlike(r"^\d+$"), 2).when(label.rlike("^[a-z]$"), 3).otherwise(4)


def nested_line_senses(entries: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sense_at, label, level, h_number, parent_h_number, text: the senses of ``line_entries`` as a tree.

    Roman numbers stand above figures, these above letters; the parent is the nearest earlier sense of a higher
    level.  h_number counts the senses of an entry from 1 behind its keys.
    """
    s = entries.select(*keys, F.posexplode("senses").alias("at0", "s")).select(*keys, (F.col("at0") + 1).alias("sense_at"), "s.label", "s.text")
    s = s.withColumn("level", sense_level(F.col("label")))
    h = F.concat_ws(".", *[F.col(k).cast("string") for k in keys], F.col("sense_at").cast("string"))
    s = windows.nearest_shallower(s.withColumn("h_number", h), keys, "sense_at", F.col("level"), "h_number", 5, "parent_h_number")
    return s.select(*keys, "sense_at", "label", "level", "h_number", "parent_h_number", "text")
