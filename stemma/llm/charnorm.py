"""Visually identical text with different characters: one standard spelling.

Values whose characters are all standard already and cannot interact (the quick check of
normalization forms, extended by look-alikes) are passed on.  Of the others every distinct value is
exploded to positioned code points, joined with a broadcast table of decompositions, look-alikes,
invisible characters, blanks and hyphens of all planes, its combining marks are ordered by class inside each
cluster, clusters are recomposed and the string is rebuilt.  Look-alikes are the public confusables of
Unicode, as the library of characters inside Spark carries them: a letter of another script that shares its
skeleton with one letter of the value's alphabet stands for that letter.  A short list beside it holds what
is alike in print only, and which of two letters is meant.

Standard spelling: canonical composition; nothing invisible; plain blanks, none at the ends; plain
hyphens; full-width, half-width and mathematical forms, long s and typographic ligatures as plain letters; letters
of the alphabet the value belongs to.  Raised letters, marks without a joined character, and ъ ь stay.

The alphabet is Greek if the value has letters only Greek has, or if its language is written in Greek
and it has no letter only Latin has; otherwise it is Latin.

Defined results: null stays null; empty and blank-only text becomes empty; ties and repeated values
get the same result; text of any length is handled as rows of code points; an empty table gives an
empty result.  Hangul jamo are not joined into syllables.
"""

from __future__ import annotations

import sys
import unicodedata as ud
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stemma.session import spread_join

# fixed values: letters that look alike in print or whose case is to be chosen, foreign letter -> letter of the alphabet
LATIN_TWINS = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j",
    "һ": "h", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ә": "ə", "ӕ": "æ", "к": "k", "ѵ": "v", "ӡ": "ʒ",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "Х": "X", "У": "Y", "І": "I", "Ѕ": "S", "Ј": "J", "Ӏ": "I", "Ԛ": "Q", "Ԝ": "W", "Ә": "Ə", "Ӕ": "Æ",
    # Greek
    "υ": "u", "ν": "v", "ο": "o", "ϸ": "þ", "α": "a", "ρ": "p", "ι": "i", "κ": "k", "χ": "x", "γ": "y", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϸ": "Þ", "Ϳ": "J",
    # Latin variants and others
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "օ": "o", "ո": "n", "ս": "u", "հ": "h",
}
GREEK_TWINS = {
    "u": "υ", "v": "ν", "o": "ο", "p": "ρ", "x": "χ", "ı": "ι", "ɩ": "ι", "ɑ": "α", "a": "α", "i": "ι", "k": "κ",
    "y": "γ", "n": "η", "w": "ω", "ĸ": "κ", "ʋ": "υ",
    "A": "Α", "B": "Β", "E": "Ε", "Z": "Ζ", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο",
    "P": "Ρ", "T": "Τ", "Y": "Υ", "X": "Χ",
    "а": "α", "о": "ο", "р": "ρ", "х": "χ", "і": "ι", "к": "κ", "ѵ": "ν", "у": "γ", "е": "ε", "т": "τ", "ԝ": "ω",
    "А": "Α", "В": "Β", "Е": "Ε", "К": "Κ", "М": "Μ", "Н": "Η", "О": "Ο", "Р": "Ρ", "Т": "Τ", "Х": "Χ", "І": "Ι",
    "µ": "μ", "ß": "β", "ϲ": "σ",
}
#: Greek letters that have a Latin twin prove nothing about the alphabet.
NO_PROOF_OF_GREEK = "υνοϸ"
HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe63\uff0d\u2043"
#: Invisible characters besides those of the format category, and the visible ones in that category.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180f\u3164\uffa0"
VISIBLE_FORMAT = (range(0x600, 0x606), range(0x6DD, 0x6DE), range(0x70F, 0x710), range(0x890, 0x892), range(0x8E2, 0x8E3), range(0x110BD, 0x110CE), range(0x13430, 0x13460))
SELECTORS = (range(0xFE00, 0xFE10), range(0xE0100, 0xE01F0))
#: Kinds of decomposition that change how a character is drawn only.
DRAWN = ("<font>", "<wide>", "<narrow>", "<noBreak>")
#: Standard letters of another script.
KEPT = "ъьЪЬ"
GREEK_LANGUAGES = ("Gk.",)

_EDGE = r"^\s|\s$"
#: Characters that stand for themselves in Latin words: ASCII, precomposed letters, raised letters, yers.
_LATIN_SAFE = (
    r"^[ -~¡-¬®-´¶-İĲ-žƀ-ǃǍ-ǰǴ-ɐɒ-ɠɢ-ɨɪ-ʸḀ-ỿъьЪЬ]*$"
)
_GREEK_SAFE = r"^[ -@\[-`{-~Ͱ-ͳͶͷͻ-ͽΆΈ-ϖἀ-ἕἘ-Ἕἠ-ὅὈ-Ὅὐ-ὗὙ-ὰὲὴὶὸὺὼᾀ-ᾴᾶ-Ὰῂ-ῄῆ-ῈῊ]*$"
_GREEK_ONLY = r"(?=[Ͱ-Ͽἀ-῿])[^" + NO_PROOF_OF_GREEK + "αρικχγϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϷϿ" + r"]"
_LATIN_ONLY = r"(?i)[bcdefghjlmqrstzæœøðþ]"


def _plain_form(c: str) -> str | None:
    """What stands for a character in any alphabet; None for itself."""
    cp = ord(c)
    kind = ud.category(c)
    if c in INVISIBLE or any(cp in r for r in SELECTORS) or (kind == "Cf" and not any(cp in r for r in VISIBLE_FORMAT)):
        return ""
    if c in HYPHENS:
        return "-"
    if kind in ("Zs", "Zl", "Zp") or c in "\t\n\r\v\f\x85":
        return " "
    if kind == "Cc":
        return ""
    drawn = ud.decomposition(c).split(" ")
    if drawn[0] in DRAWN or c == "ſ" or 0xFB00 <= cp <= 0xFB06:
        return ud.normalize("NFKD", c)
    d = ud.normalize("NFD", c)
    return d if d != c else None


@lru_cache(maxsize=1)
def _plain_forms() -> dict[str, str]:
    out = {}
    for cp in range(sys.maxunicode + 1):
        if cp == 0x20 or 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        form = _plain_form(chr(cp))
        if form is not None:
            out[chr(cp)] = form
    return out


def _script(c: str) -> str:
    return ud.name(c, "").partition(" ")[0]


def confusables(spark: SparkSession) -> dict[str, dict[str, str]]:
    """alphabet -> letter of another script -> letter of the alphabet with the same skeleton and case.

    A skeleton that several letters of the alphabet share tells nothing and is left out.
    """
    jvm = spark.sparkContext._jvm
    checker = getattr(jvm, "com.ibm.icu.text.SpoofChecker$Builder")().build()
    ends = (range(0x41, 0x590), range(0x10A0, 0x1400), range(0x1C80, 0x1CC0), range(0x2C00, 0x2E00), range(0xA4D0, 0xA500), range(0xA640, 0xA6A0), range(0xA720, 0xAC00), range(0x10280, 0x10600), range(0x16E40, 0x16EA0), range(0x1E000, 0x1E100))
    letters = [chr(cp) for r in ends for cp in r if ud.category(chr(cp)) in ("Lu", "Ll", "Lo") and ud.normalize("NFD", chr(cp)) == chr(cp)]
    skeletons = dict(zip(letters, checker.getSkeleton("\n".join(letters)).split("\n"), strict=True))
    own = {
        "latin": [c for c in letters if c.isascii()],
        "greek": [c for c in letters if _script(c) == "GREEK" and 0x391 <= ord(c) <= 0x3C9],
    }
    out: dict[str, dict[str, str]] = {}
    for alphabet, members in own.items():
        meant: dict[tuple[str, bool], list[str]] = {}
        for c in members:
            meant.setdefault((skeletons[c], c.isupper()), []).append(c)
        script = alphabet.upper()
        out[alphabet] = {
            c: meant[k][0] for c, s in skeletons.items()
            if _script(c) != script and c not in KEPT and len(meant.get(k := (s, c.isupper()), [])) == 1
        }
    return out


def code_points(spark: SparkSession) -> list[tuple[str, str, str]]:
    """(alphabet, character, what stands for it)."""
    both, alike = _plain_forms(), confusables(spark)
    rows = []
    for alphabet, twins in (("latin", LATIN_TWINS), ("greek", GREEK_TWINS)):
        twins = alike[alphabet] | twins
        plain = lambda s: "".join(twins.get(x, x) for x in s)  # noqa: B023, E731
        # a drawn form stays the letter it draws; what is composed of a look-alike follows it
        own = {c: plain(d) if ud.decomposition(c)[:1] != "<" else d for c, d in both.items()}
        own |= {c: ud.normalize("NFD", t) for c, t in twins.items()}
        rows += [(alphabet, c, d) for c, d in own.items() if d != c]
    return rows


def code_point_table(spark: SparkSession) -> DataFrame:
    """(alphabet, ch, rep): fixed by the Unicode tables and the twins above, so its size is bounded."""
    return spark.createDataFrame(pd.DataFrame(code_points(spark), columns=["alphabet", "ch", "rep"]))


def mark_table(spark: SparkSession) -> DataFrame:
    """(m, ccc): combining marks and their class, fixed by the Unicode tables."""
    rows = [(chr(cp), ud.combining(chr(cp))) for cp in range(0x300, sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF and ud.combining(chr(cp))]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["m", "ccc"]))


def alphabet_of(value: Column, lang: Column) -> Column:
    greek = value.rlike(_GREEK_ONLY) | (
        F.coalesce(lang.isin(*GREEK_LANGUAGES), F.lit(False)) & ~value.rlike(_LATIN_ONLY)
    )
    return F.when(greek, "greek").otherwise("latin")


def is_quick(value: Column, alphabet: Column) -> Column:
    safe = F.when(alphabet == "greek", value.rlike(_GREEK_SAFE)).otherwise(value.rlike(_LATIN_SAFE))
    return safe & ~value.rlike(_EDGE)


@F.pandas_udf(StringType())
def _recompose(cluster: pd.Series) -> pd.Series:
    return cluster.map(lambda s: ud.normalize("NFC", s))


def standard_forms(values: DataFrame) -> DataFrame:
    """(v, alphabet) -> (v, alphabet, standard) for distinct values that are not quick."""
    spark = values.sparkSession
    chars = values.select("v", "alphabet", F.posexplode(F.split("v", "")).alias("pos", "ch")).where("ch <> ''")
    chars = chars.join(F.broadcast(code_point_table(spark)), ["alphabet", "ch"], "left").withColumn("rep", F.coalesce("rep", "ch"))
    points = chars.select("v", "alphabet", "pos", F.posexplode(F.split("rep", "")).alias("sub", "m")).where("m <> ''")
    points = points.join(F.broadcast(mark_table(spark)), "m", "left").withColumn("ccc", F.coalesce("ccc", F.lit(0)))
    w = Window.partitionBy("v", "alphabet").orderBy("pos", "sub")
    points = points.withColumn("cluster", F.sum((F.col("ccc") == 0).cast("int")).over(w))
    parts = points.groupBy("v", "alphabet", "cluster").agg(F.array_sort(F.collect_list(F.struct("ccc", "pos", "sub", "m"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["m"]), "")
    parts = parts.select("v", "alphabet", "cluster", text.alias("c"), (F.size("p") > 1).alias("marked"))
    parts = parts.withColumn("c", F.when(F.col("marked"), _recompose(F.when(F.col("marked"), F.col("c")).otherwise(""))).otherwise(F.col("c")))
    whole = parts.groupBy("v", "alphabet").agg(F.array_sort(F.collect_list(F.struct("cluster", "c"))).alias("p"))
    built = F.trim(F.array_join(F.transform("p", lambda x: x["c"]), ""))
    # a value of invisible characters alone leaves no code point
    return values.select("v", "alphabet").join(whole, ["v", "alphabet"], "left").select(
        "v", "alphabet", F.coalesce(built, F.lit("")).alias("standard")
    )


def standardize(df: DataFrame, value: str, lang: str | None, out: str = "standard") -> DataFrame:
    """Add ``out``, the standard spelling of ``value``; all rows and columns are kept."""
    v = F.col(f"`{value}`")
    language = F.col(f"`{lang}`") if lang else F.lit(None).cast("string")
    tagged = df.withColumn("__alphabet", alphabet_of(v, language)).withColumn(
        "__quick", v.isNull() | is_quick(v, F.col("__alphabet"))
    )
    odd = tagged.where("not __quick")
    forms = standard_forms(odd.select(v.alias("v"), F.col("__alphabet").alias("alphabet")).distinct())
    # names no table has, so that none of the rows' own columns can clash
    forms = forms.toDF("__form", "__form_alphabet", "__standard")
    own = [F.col(f"`{c}`") for c in df.columns]
    # rows of a frequent value are spread by all they hold
    odd = odd.withColumn("__value", v).withColumn("__spread", F.xxhash64(*own))
    fixed = spread_join(odd, forms, [("__value", "__form"), ("__alphabet", "__form_alphabet")], ["__spread"])
    fixed = fixed.withColumn(out, F.col("__standard")).drop("__form", "__form_alphabet", "__standard", "__alphabet", "__quick", "__value", "__spread")
    quick = tagged.where("__quick").drop("__alphabet", "__quick").withColumn(out, v)
    return quick.unionByName(fixed)
