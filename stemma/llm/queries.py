"""Queries of the text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import canonical, charnorm, linkage, mixing, packing, quality, tokens, truncation
from stemma.session import cut, spread_join, table

# ---------------------------------------------------------------- standard spelling


def _forms(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "lex_ref_link")
    pairs = table(spark, sf, "temp_on_matching")
    zero = F.lit(0).alias("lemma_id")
    return (
        links.select(F.lit("reflex").alias("field_name"), "lex_ref_link_id", zero, "lang", F.col("reflex").alias("value"))
        .unionByName(links.select(F.lit("reflex_normalized").alias("field_name"), "lex_ref_link_id", zero, "lang", F.col("reflex_normalized").alias("value")))
        .unionByName(pairs.select(F.lit("lemma_normalized").alias("field_name"), "lex_ref_link_id", "lemma_id", "lang", F.col("lemma_normalized").alias("value")))
    )


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    done = charnorm.standardize(_forms(spark, sf).where("value is not null"), "value", "lang")
    return done.where("value <> standard").select("field_name", "lex_ref_link_id", "lemma_id").distinct()


def p2_standard(spark: SparkSession, sf: str) -> DataFrame:
    """Every form with its standard spelling."""
    return charnorm.standardize(_forms(spark, sf).where("value is not null"), "value", "lang").select(
        "field_name", "lex_ref_link_id", "lemma_id", "lang", "value", "standard"
    )


QUERIES = {"p2_found": p2_found, "p2_standard": p2_standard}
ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- canonical languages


# fixed values: names of languages that no listed spelling shows, by a spelling of the same language
_NAMES = {
    "altindisch": "aind", "altgriechisch": "agr", "altkirchenslavisch": "aksl", "altkirchenslawisch": "aksl",
    "altbulgarisch": "abg", "altisländisch": "aisl", "altnordisch": "altnordi", "gotisch": "got",
}


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.vocabulary(spark, table(spark, sf, "lang_abbrev_master"), "abbrev_id", "eng_abbrev", "source_abbrev", "full_language_name", _NAMES)


def _typed_languages(spark: SparkSession, sf: str) -> DataFrame:
    listed = table(spark, sf, "lang_abbrev_master").select(F.explode(F.split("source_abbrev", ",")).alias("l")).select(F.trim("l").alias("listed")).distinct()
    links = table(spark, sf, "lex_ref_link").select(
        F.lit("lex_ref_link").alias("source_table"), F.col("lex_ref_link_id").cast("string").alias("row_key"), F.col("orig_lang_abbrev").alias("v")
    )
    links = links.where("v is not null").join(F.broadcast(listed), F.col("v") == F.col("listed"), "left_anti")
    raw = table(spark, sf, "unmapped_summary").select(
        F.lit("unmapped_summary").alias("source_table"), F.col("orig_lang_abbrev_raw").alias("row_key"), F.col("orig_lang_abbrev_raw").alias("v")
    )
    return links.unionByName(raw.where("v is not null"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = _typed_languages(spark, sf)
    mapped = canonical.canonicalize(rows.select("v").distinct(), _vocabulary(spark, sf)).select(F.col("v").alias("m_v"), "entry")
    return spread_join(rows, mapped, [("v", "m_v")], ["source_table", "row_key"]).select(
        "source_table", "row_key", F.coalesce("entry", F.lit(0)).alias("abbrev_id")
    ).distinct()


def p7_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    """Values that name no entry, with the number of rows they hold in either table."""
    rows = _typed_languages(spark, sf)
    counted = rows.groupBy("v", "source_table").agg(F.count(F.lit(1)).alias("n_rows"))
    mapped = canonical.canonicalize(rows.select("v").distinct(), _vocabulary(spark, sf)).select(F.col("v").alias("m_v"))
    return counted.join(mapped, F.col("v") == F.col("m_v"), "left_anti").select(F.col("v").alias("typed_value"), "source_table", "n_rows")


QUERIES |= {"p7_found": p7_found, "p7_unmapped": p7_unmapped}

# ---------------------------------------------------------------- text quality


def p10_statistics(spark: SparkSession, sf: str) -> DataFrame:
    common = quality.common_words(table(spark, sf, "common_words"))
    return quality.statistics(table(spark, sf, "documents"), "doc_id", "text", common)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return p10_statistics(spark, sf).where("kind in ('list', 'table', 'junk')").select("doc_id").distinct()


QUERIES |= {"p10_found": p10_found, "p10_statistics": p10_statistics}

# ---------------------------------------------------------------- cut texts

_FIELDS = {"gloss": truncation.Field(ref="item"), "reflex": truncation.Field(ref="prefix", forms=True), "rt_gloss_eng": truncation.Field(prose=True)}


def _cut_candidates(spark: SparkSession, sf: str) -> DataFrame:
    master, roots = table(spark, sf, "lex_master"), table(spark, sf, "rt_ref_link")
    parts = [
        master.select(F.lit("gloss").alias("field"), F.col("lang").alias("source_key"), F.col("lemma_id").alias("row_id"), F.col("gloss").alias("value"), F.col("entry_str").alias("ref")),
        master.select(F.lit("reflex").alias("field"), F.col("lang").alias("source_key"), F.col("lemma_id").alias("row_id"), F.col("reflex").alias("value"), F.col("orthography").alias("ref")),
        roots.select(F.lit("rt_gloss_eng").alias("field"), F.col("ref_id").alias("source_key"), F.col("rt_ref_link_id").alias("row_id"), F.col("rt_gloss_eng").alias("value"), F.lit(None).cast("string").alias("ref")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p4_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every value with the probability that it was cut."""
    scored, _ = truncation.score(_cut_candidates(spark, sf), _FIELDS)
    return scored.select(F.col("field").alias("field_name"), "source_key", "row_id", "value", "ref", F.when(F.col("distance") >= 0, F.col("distance")).alias("length_to_limit"), "known", "probability")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_scored(spark, sf).where("probability > 0.5").select("field_name", "source_key", "row_id").distinct()


def p4_rates(spark: SparkSession, sf: str) -> DataFrame:
    """How often each source truncates."""
    cut_ = F.col("probability") > 0.5
    once = p4_scored(spark, sf).groupBy("field_name", "source_key", "row_id").agg(F.max("probability").alias("probability"))
    return once.groupBy("field_name", "source_key").agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if(cut_).alias("n_cut"), F.avg(cut_.cast("double")).alias("cut_rate")
    )


QUERIES |= {"p4_found": p4_found, "p4_scored": p4_scored, "p4_rates": p4_rates}

# ---------------------------------------------------------------- linkage


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary entries, those that say the same once, one row per written form (lemma and transliteration)."""
    m = table(spark, sf, "lex_master").where("lang is not null and lemma_id is not null")
    forms = F.array_distinct(F.filter(F.array(linkage.folded(F.col("lemma")), linkage.folded(F.col("lemma_translit"))), lambda f: f.isNotNull() & (f != "")))
    # senses become hashes before the versions of an entry meet: less to shuffle than their text
    m = m.select("lang", "lemma_id", "last_updated", forms.alias("forms"), linkage.entry_items(F.col("gloss"), F.col("entry_str")).alias("items"), F.col("page_num").alias("page"))
    m = m.groupBy("lang", "lemma_id").agg(F.max(F.struct("last_updated", "forms", "items", "page")).alias("s"))
    m = linkage.entry_classes(m.select("lang", "lemma_id", "s.forms", "s.items", "s.page"))
    return m.withColumn("skel", linkage.skeleton(F.col("fold")))


def _linkable(spark: SparkSession, sf: str, dictionaries: list[str], only_open: bool = True) -> DataFrame:
    """Attested words with their languages (null if none is given or named), standard form, senses and page.

    Rows whose languages have no dictionary stand for no entry and are left out.
    """
    r = table(spark, sf, "lex_ref_link").where("lex_ref_link_id is not null")
    if only_open:
        paired = table(spark, sf, "temp_on_matching").select("lex_ref_link_id")
        r = r.join(paired, "lex_ref_link_id", "left_anti")
    rest = ["orig_lang_abbrev", "lang", "reflex", "items", "page", "word_id"]
    r = r.select(
        F.col("lex_ref_link_id").alias("row_id"), "last_updated", "orig_lang_abbrev", "lang", "reflex",
        linkage.gloss_items(F.col("gloss_eng")).alias("items"), linkage.first_number(F.col("page_loc")).alias("page"), "word_id",
    )
    r = r.groupBy("row_id").agg(F.max(F.struct("last_updated", *rest)).alias("s")).select("row_id", *[f"s.{c}" for c in rest])
    if only_open:
        r = r.where("word_id is null")
    r = r.where("reflex is not null").drop("word_id")
    r = cut(r)
    # rows without language get those their free-typed abbreviation names
    typed = r.where("lang is null and orig_lang_abbrev is not null").select(F.col("orig_lang_abbrev").alias("v")).distinct()
    codes = table(spark, sf, "lang_abbrev_master").select(F.col("abbrev_id").alias("entry"), F.col("eng_abbrev").alias("code"))
    named = canonical.canonicalize(typed, _vocabulary(spark, sf)).join(F.broadcast(codes), "entry").groupBy(F.col("v").alias("orig_lang_abbrev")).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    r = r.join(named, "orig_lang_abbrev", "left").withColumn("langs", F.when(F.col("lang").isNotNull(), F.array("lang")).otherwise(F.col("codes")))
    r = r.where(F.col("langs").isNull() | F.arrays_overlap("langs", F.array(*map(F.lit, sorted(dictionaries))).cast("array<string>")))
    # the alphabet of one language; without one, or with several, the letters tell
    r = r.withColumn("lang", F.when(F.size("langs") == 1, F.col("langs")[0]))
    r = charnorm.standardize(r, "reflex", "lang", "form")
    r = r.select(
        "row_id", "langs", linkage.folded(F.col("form")).alias("fold"), F.array_sort("items").alias("items"), "page", F.col("form").endswith("-").alias("is_stem")
    )
    return r.where("fold <> ''").withColumn("skel", linkage.skeleton(F.col("fold")))


def p5_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The entry each open row stands for, with a confidence."""
    # the dictionaries there are, each tried for rows whose language is neither given nor named
    languages = [x["lang"] for x in table(spark, sf, "lex_master").where("lang is not null").select("lang").distinct().collect()]
    found = linkage.link(cut(_linkable(spark, sf, languages)), cut(_entries(spark, sf)), languages)
    return found.select("lang", "lemma_id", F.col("row_id").alias("lex_ref_link_id"), "confidence")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_matches(spark, sf).select("lang", "lemma_id", "lex_ref_link_id")


QUERIES |= {"p5_found": p5_found, "p5_matches": p5_matches}

# ---------------------------------------------------------------- containers


def _token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and token count, counted once."""
    return cut(table(spark, sf, "documents").select("doc_id", tokens.n_tokens(F.col("text")).alias("n_tokens")))


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every document in a container of each capacity."""
    docs = _token_counts(spark, sf)
    rows = table(spark, sf, "pack_budgets").where("capacity_tokens is not null").select("budget_name", "capacity_tokens").distinct().collect()
    packed = packing.pack(docs, "doc_id", "n_tokens", {r["budget_name"]: r["capacity_tokens"] for r in sorted(rows)})
    return packed.select(F.col("budget").alias("budget_name"), "container_id", "start_token", "doc_id", "piece_no", "n_tokens", "filled_by")


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    """Containers and share of room used for each capacity, those filled by combinations, and the least number of containers."""
    budgets = table(spark, sf, "pack_budgets").select("budget_name", "capacity_tokens").distinct()
    filled = p8_packed(spark, sf).where("container_id is not null").groupBy("budget_name", "container_id").agg(
        F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("items"), F.max(F.col("start_token") + F.col("n_tokens")).alias("ends"), F.max("filled_by").alias("filled_by")
    )
    total = filled.groupBy("budget_name").agg(
        F.count(F.lit(1)).alias("n_containers"), F.count_if(F.col("filled_by") == "combination").alias("by_combination"), F.sum("n").alias("n_tokens"),
        F.sum("items").alias("n_pieces"), F.max("n").alias("fullest"), F.max("ends").alias("furthest_end"),
    )
    return total.join(F.broadcast(budgets), "budget_name").select(
        "budget_name", "capacity_tokens", "n_containers", "by_combination", "n_pieces", "n_tokens", "fullest", "furthest_end",
        F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"),
        (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("room_used"),
    )


# ---------------------------------------------------------------- mixing


def p9_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """How often each document is used in the mix."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, "doc_id", "source", "text", table(spark, sf, "mix_targets"))


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens, repeats and share of each source in the mix beside its target, and the mean posterior of the source."""
    used = p9_mixed(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("times")).alias("used_tokens"),
        F.max("times").alias("most_repeats"), F.avg("membership").alias("mean_membership"),
    )
    targets = table(spark, sf, "mix_targets")
    used = used.join(F.broadcast(targets), "source", "full_outer")
    total = used.agg(F.sum("used_tokens").alias("t"))
    return used.crossJoin(F.broadcast(total)).select(
        "source", "n_docs", "n_tokens", "used_tokens", "most_repeats", "max_repeats", "target_share", "mean_membership",
        F.when(F.col("t") > 0, F.coalesce("used_tokens", F.lit(0)) / F.col("t")).alias("reached_share"),
    )


QUERIES |= {"p8_packed": p8_packed, "p8_report": p8_report, "p9_mixed": p9_mixed, "p9_report": p9_report}
