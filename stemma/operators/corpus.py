"""Annotated corpora: tokens with their place, aligned to lines, by a pluggable annotator."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.operators import windows

FIELDS = ("pos", "lemma", "stem", "dependency_relation", "governor", "features", "category", "syllables", "phonetic_transcription")
_TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]"


def tokenize(lines: DataFrame, doc: str = "file", order: str = "seq", body: str = "text") -> DataFrame:
    """One row per token with its index in line, sentence and document; model fields are null.

    Quotes and blanks belong to no token, as in the line alignment of annotated texts.
    """
    clean = F.regexp_replace(F.col(body), "[“”]", " ")
    toks = lines.select("*", F.posexplode(F.regexp_extract_all(clean, F.lit(_TOKEN), F.lit(0))).alias("line_token", "token"))
    w = Window.partitionBy(doc).orderBy(order, "line_token")
    ends = F.col("token").isin(".", "!", "?")
    toks = toks.withColumn("doc_token_index", F.row_number().over(w) - 1)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    toks = toks.withColumn("index_sentence", F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)))
    punctuation = F.when(F.col("token").rlike(r"^[^\p{L}\p{M}\p{N}_]$"), "punctuation")
    toks = toks.withColumn("pos", punctuation)
    for f in FIELDS[1:]:
        toks = toks.withColumn(f, F.lit(None).cast("string"))
    return toks


#: What belongs to no token: blanks and quotes.
_OUTSIDE = r"[\s“”]+"


def align_tokens(lines: DataFrame, tokens: DataFrame, doc: str, line_order: str, body: str, token_order: str, token: str, enclitic: str = "que") -> DataFrame:
    """tokens with ``line``, the line of the document that each begins in.

    Lines and tokens are laid on one axis, the letters of the document without blanks and quotes: a token lies in
    the last line that begins at or before it.  An annotator that splits an enclitic off a word it leaves whole
    gives it twice; the second one takes no letters.
    """
    letters = lambda c: F.length(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), _OUTSIDE, ""))
    before = Window.partitionBy(doc).orderBy(token_order)
    twice = (F.lower(token) == enclitic) & F.lower(F.lag(token).over(before)).endswith(enclitic)
    t = tokens.withColumn("__size", F.when(F.coalesce(twice, F.lit(False)), 0).otherwise(letters(token)))
    t = windows.running_sum(t, "__size", [doc], token_order, "__end").withColumn("__at", F.col("__end") - F.col("__size"))
    # what takes no letters belongs to the token before it
    t = t.withColumn("__at", F.when(F.col("__size") == 0, F.greatest(F.col("__at") - 1, F.lit(0))).otherwise(F.col("__at")))
    own = lines.select(F.col(doc).alias("__doc"), F.col(line_order).alias("__line"), letters(body).alias("__size"))
    own = windows.running_sum(own, "__size", ["__doc"], "__line", "__end").where("__size > 0")
    marks = own.select("__doc", "__line", F.struct((F.col("__end") - F.col("__size")).cast("long").alias("at"), F.lit(0).alias("kind"), F.col("__line").cast("string").alias("o")).alias("__place"))
    spots = t.select(F.col(doc).alias("__doc"), F.lit(None).cast(lines.schema[line_order].dataType).alias("__line"),
                     F.struct(F.col("__at").cast("long").alias("at"), F.lit(1).alias("kind"), F.col(token_order).cast("string").alias("o")).alias("__place"),
                     F.struct(*[F.col(f"`{c}`") for c in tokens.columns]).alias("__row"))
    both = marks.withColumn("__row", F.lit(None).cast(spots.schema["__row"].dataType)).unionByName(spots)
    placed = windows.fill_forward(both, "__line", ["__doc"], "__place", "line")
    return placed.where("__row is not null").select("__row.*", "line")


def annotate(tokens: DataFrame, provider: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Fill the model fields with ``provider``, batch by batch; empty features become null."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield provider(batch)[list(batch.columns)]

    out = tokens.mapInPandas(rows, tokens.schema)
    return out.select(*[null_if_empty(F.col(c)).alias(c) if c in FIELDS else F.col(c) for c in tokens.columns])


def null_if_empty(c: Column) -> Column:
    return F.when(~c.isin("", "{}", "[]"), c)


def display_tokens(tokens: DataFrame) -> DataFrame:
    """token and id, where punctuation has none."""
    return tokens.select("*", F.when(F.coalesce(F.col("pos"), F.lit("")) != "punctuation", F.col("doc_token_index")).alias("id"))


def layout(lines: DataFrame, doc: str = "file", order: str = "seq") -> DataFrame:
    """(doc, has_book, has_chapter) as the first line of each document tells."""
    first = lines.groupBy(doc).agg(F.min(F.struct(order, F.col("book").isNotNull().alias("b"), F.col("chapter").isNotNull().alias("c"))).alias("f"))
    return first.select(doc, F.col("f.b").alias("has_book"), F.col("f.c").alias("has_chapter"))


def lookup_form(tokens: DataFrame, form: str) -> DataFrame:
    return tokens.where(F.col("token") == form)


def second_chance(links: DataFrame, lemmatized: DataFrame, entries: DataFrame, link_id: str) -> DataFrame:
    """Open links matched through the lemma another tool supplied for their form."""
    return links.join(lemmatized.select(link_id, "lemma"), link_id).join(entries, "lemma", "left")


# fixed values: first letter of a tag and the part of speech it stands for
TAG_LETTERS = {
    "N": "n.", "V": "v.", "A": "adj.", "D": "adv.", "R": "prep.", "C": "conj.", "G": "conj.", "M": "numer.", "T": "part.", "I": "interj.", "E": "interj.",
    "P": "pron.", "L": "art.",
}


def pos_of_tags(tags: Column) -> Column:
    """Part of speech of an entry by the tags of its words: the first tag that says anything decides, an unknown letter gives null."""
    letters = F.create_map(*[F.lit(x) for pair in TAG_LETTERS.items() for x in pair])
    telling = F.filter(tags, lambda t: t.isNotNull() & (t != "") & ~t.startswith("-"))
    return F.try_element_at(letters, F.substring(F.try_element_at(telling, F.lit(1)), 1, 1))


def transcribe(words: DataFrame, word: str, lang: str, providers: dict[str, Callable[[str], str]], out: str = "ipa") -> DataFrame:
    """Add the transcription of each word by the provider of its language; empty where it fails or there is none."""

    def one(w: str | None, code: str | None) -> str | None:
        if w is None:
            return None
        try:
            return providers[code](w) if code in providers else ""
        except Exception:  # noqa: BLE001 - a provider may fail in its own ways, and the word stays without transcription
            return ""

    @F.pandas_udf("string")
    def run(w: pd.Series, code: pd.Series) -> pd.Series:
        return pd.Series([one(a, b) for a, b in zip(w, code)], dtype="object")

    return words.withColumn(out, run(word, lang))
