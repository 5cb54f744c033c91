"""String functions as column expressions; the few without a built-in are Arrow functions."""

from __future__ import annotations

import html
import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _accent_table() -> tuple[str, str]:
    """Precomposed letters and their base letter, from the Unicode decompositions."""
    src, dst = [], []
    for cp in [*range(0xC0, 0x250), *range(0x386, 0x530), *range(0x1E00, 0x2000)]:
        base = "".join(c for c in ud.normalize("NFD", chr(cp)) if not ud.combining(c))
        if len(base) == 1 and base != chr(cp):
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENTED, _BARE = _accent_table()


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _ACCENTED, _BARE), r"\p{Mn}", "")


def fold_key(c: Column) -> Column:
    """Accent- and case-insensitive, pad-space key: the fast path of the collated comparison."""
    return F.rtrim(F.lower(strip_accents(c)))


def collated(c: Column, name: str = "UNICODE_CI_AI") -> Column:
    """Comparison under a collation; keep stored columns plain and collate in the comparison only."""
    return F.collate(c, name)


def latin_letters(c: Column) -> Column:
    return F.translate(c, "vj", "ui")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " +", " "))


def match_key(c: Column) -> Column:
    """Marks of reconstruction, hyphens, brackets and digits off, consonantal letters folded, first word."""
    bare = F.regexp_replace(F.regexp_replace(latin_letters(c), r"[-()*]", ""), r"[0-9]", "")
    return F.regexp_substr(squeeze(bare), F.lit(r"[\p{L}\p{M}\p{N}_]+"))


def first_word(c: Column) -> Column:
    return F.regexp_substr(c, F.lit(r"[\p{L}\p{M}\p{N}_]+"))


def all_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))


def before(c: Column, mark: str) -> Column:
    """What stands before the first mark; empty where there is none."""
    return F.substring(c, F.lit(1), F.greatest(F.locate(mark, c) - 1, F.lit(0)))


def noun_gender(pos: Column) -> tuple[Column, Column]:
    """(pos, gender) of values like 'n. m.': only where a noun mark stands first."""
    is_noun = pos.rlike(r"^n\.")
    gender = F.when(is_noun, F.nullif(F.trim(F.substring(pos, F.lit(3), F.length(pos))), F.lit("")))
    return F.when(is_noun, F.lit("n.")).otherwise(pos), gender


def punctuation_spacing(c: Column) -> Column:
    """No blank before closing marks or after opening ones, one after separators and between brackets back to back, single blanks."""
    c = F.regexp_replace(c, r" (?=[,.;:)\]])", "")
    c = F.regexp_replace(c, r"(?<=[(\[]) ", "")
    c = F.regexp_replace(c, r"(?<=[,;:])(?! )", " ")
    c = F.regexp_replace(c, r"(?<=[)\]])(?=[(\[])", " ")
    return F.regexp_replace(c, " +", " ")


def balanced(c: Column, trim_set: str = " ,;:") -> Column:
    """Outer separators off, missing brackets added at the side where they lack."""
    c = F.trim(c, F.lit(trim_set))
    for a, b in (("(", ")"), ("[", "]")):
        n_open = F.length(c) - F.length(F.replace(c, F.lit(a), F.lit("")))
        n_close = F.length(c) - F.length(F.replace(c, F.lit(b), F.lit("")))
        lack_open, lack_close = F.greatest(n_close - n_open, F.lit(0)), F.greatest(n_open - n_close, F.lit(0))
        c = F.concat(F.repeat(F.lit(a), lack_open), c, F.repeat(F.lit(b), lack_close))
    return c


def homonym(c: Column) -> tuple[Column, Column]:
    """(form, number) of forms with a trailing homonym number; the number is null where there is none."""
    return F.regexp_replace(c, r"\d+$", ""), F.nullif(F.regexp_extract(c, r"(\d+)$", 1), F.lit("")).try_cast("int")


def without_pitch(c: Column) -> Column:
    return F.regexp_replace(c, "[\\u0300-\\u0302]", "")


def repair_mojibake(c: Column) -> Column:
    """UTF-8 once read as Latin-1, where every character allows it and the bytes are UTF-8."""
    candidate = c.rlike("[\\u00c2-\\u00f4][\\u0080-\\u00bf]") & ~c.rlike("[^\\u0000-\\u00ff]")
    # every lead byte is followed by its continuation bytes and none stands alone
    sound = c.rlike(
        "^(?:[\\u0000-\\u007f]|[\\u00c2-\\u00df][\\u0080-\\u00bf]|[\\u00e0-\\u00ef][\\u0080-\\u00bf]{2}|[\\u00f0-\\u00f4][\\u0080-\\u00bf]{3})*$"
    )
    ok = candidate & sound
    return F.when(ok, F.decode(F.encode(F.when(ok, c).otherwise(""), "ISO-8859-1"), "UTF-8")).otherwise(c)


def abbreviation(c: Column) -> Column:
    """Outer blanks and quotes off, no-break blanks plain, broken encoding mended, composed."""
    c = F.trim(F.trim(F.trim(c), F.lit('"')), F.lit("'"))
    return nfc(repair_mojibake(F.replace(c, F.lit("\u00a0"), F.lit(" "))))


def abbreviation_key(c: Column) -> Column:
    """What two spellings of an abbreviation share but for a closing stop: lower case, single blanks."""
    return F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))


def abbreviation_tokens(c: Column) -> Column:
    """Distinct parts of a cleaned abbreviation at ; , / and blanks; a lone part is split at its hyphens."""
    flat = F.regexp_replace(c, r"[()\[\]{}]", " ")
    parts = F.filter(F.split(flat, r"[;,/]|\s+"), lambda p: p != "")
    lone = (F.size(parts) == 1) & F.contains(parts[0], F.lit("-"))
    return F.array_distinct(F.when(lone, F.filter(F.split(parts[0], "-"), lambda p: p != "")).otherwise(parts))


def is_blank(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("", "nan")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]*>", "")


def lower_tags(c: Column) -> Column:
    for tag in "BI":
        c = F.replace(F.replace(c, F.lit(f"<{tag}>"), F.lit(f"<{tag.lower()}>")), F.lit(f"</{tag}>"), F.lit(f"</{tag.lower()}>"))
    return c


def body_text(lang: Column, c: Column) -> Column:
    return F.concat(F.lit('<div class="'), lang, F.lit(' bodytext">'), c, F.lit("</div>"))


def tags(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"<([A-Za-z][A-Za-z0-9]*)"), F.lit(1))


def shortened(c: Column, at: int = 400) -> Column:
    return F.when(F.length(c) > at, F.concat(F.substring(c, 1, at), F.lit(" …"))).otherwise(c)


def file_parts(name: Column) -> tuple[Column, Column]:
    """(author, work) of a file name author.work[.part].suffix."""
    base = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.(?:tess|sty|txt)$", "")
    parts = F.split(base, r"\.")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def pos_from_text(c: Column) -> Column:
    """Part of speech by key words of the running text, then by verb classes and voices; empty where nothing tells."""
    low = F.lower(F.coalesce(c, F.lit("")))
    alone = r"(?<![\p{L}\p{N}_])"
    verb = low.rlike(alone + r"cl\.\s*\d") | F.coalesce(c, F.lit("")).rlike(alone + r"(?:P|Ā|U)\.")
    ladder = F.when(F.contains(low, F.lit("interjection")), "interj.")
    for word, pos in (("prefix", "pref."), ("particle", "part.")):
        ladder = ladder.when(F.contains(low, F.lit(word)), pos)
    return ladder.when(verb, "v.").otherwise("")


def line_mark(c: Column) -> Column:
    """The text of an annotated line without its '<...> ' mark."""
    return F.regexp_replace(c, r"^<[ a-zA-Z0-9.\-]*>\s", "")


def location(c: Column) -> tuple[Column, Column, Column]:
    """(book, chapter, line) of a line mark: three parts, book and line, or the line alone."""
    mark = r"<[^>]*?(\d+(?:-\d+)?)(?:\.([a-zA-Z0-9]+))?(?:\.(\d+))?>"
    one, two, three = (F.nullif(F.regexp_extract(c, mark, i), F.lit("")) for i in (1, 2, 3))
    book = F.when(two.isNotNull(), one)
    return book, F.when(three.isNotNull(), two), F.coalesce(three, two, one)


# fixed values: letters and ligatures that the addresses of the dictionary pages write otherwise
SLUG_LETTERS = ("áýðúéóöøí ", "aydueoooi-")
SLUG_DIGRAPHS = (("þ", "th"), ("æ", "ae"), ("œ", "oe"))


def slug(c: Column) -> Column:
    """A lemma as the last part of a page address; a closing hyphen goes."""
    c = F.regexp_replace(F.translate(F.lower(c), *SLUG_LETTERS), "-$", "")
    for a, b in SLUG_DIGRAPHS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@F.pandas_udf(StringType())
def nfc(c: pd.Series) -> pd.Series:
    return c.map(lambda s: ud.normalize("NFC", s), na_action="ignore")


# fixed values: endings of entity names that put a mark on the letter before them, and single entities
ENTITY_MARKS = {"acute": "\u0301", "long": "\u0304", "short": "\u0306", "odot": "\u0307", "udot": "\u0323", "tilde": "\u0303"}
ENTITY_LIGATURES = {"acute": "\u0301", "long": "\u0304", "circ": "\u0302"}
ENTITIES = {
    "OElig-acute": "\u0152\u0301", "oelig-acute": "\u0153\u0301", "dash-acute": "\u0903\u0301", "t-super": "\u1d57", "e-super": "\u1d49",
    "alpha-tonos": "ά", "epsilon-tonos": "έ", "eta-tonos": "ή", "omicron-tonos": "ό", "iota-tonos": "ί", "upsilon-tonos": "ύ", "omega-tonos": "ώ",
    "iota-oxia": "\u1f77", "iota-diar": "ϊ", "upsilon-dasia-oxia": "ὕ", "w-circ": "\u0302ω",
    "b-rune": "ᛒ", "c-rune": "ᚳ", "d-rune": "ᛞ", "e-rune": "ᛖ", "f-rune": "ᚠ", "i-rune": "ᛁ", "l-rune": "ᛚ", "m-rune": "ᛗ", "n-rune": "ᚾ",
    "ng-rune": "ᛝ", "p-rune": "ᛈ", "u-rune": "ᚢ", "w-rune": "ᚹ", "y-rune": "ᚣ",
    "yogh": "ȝ", "YOGH": "Ȝ", "dash-uncertain": "\u0903", "hand": "☞",
}
#: These stand without a closing semicolon.
ENTITY_STROKES = {"b-bar": "ƀ", "THORN-bar": "Ꝥ", "thorn-bar": "ꝥ"}
_NAMED_ENTITY = re.compile(r"&([A-Za-z]+(?:-[a-z]+)*);")
_STROKE = re.compile("&(" + "|".join(ENTITY_STROKES) + ")")
_LIGATURE = re.compile("[Ææ]-(" + "|".join(ENTITY_LIGATURES) + ");")


def _entity(m: re.Match) -> str:
    name = m[1]
    if name in ENTITIES:
        return ENTITIES[name]
    letter, _, mark = name.partition("-")
    # the acute is put on small letters only
    if len(letter) == 1 and mark in ENTITY_MARKS and (mark != "acute" or letter.islower()):
        return letter + ENTITY_MARKS[mark]
    return m[0]


def unescape_entities(s: str) -> str:
    """Entities by HTML, then those of the dictionary's own names; ampersands that open none are escaped again."""
    s = _LIGATURE.sub(lambda m: "æ" + ENTITY_LIGATURES[m[1]], html.unescape(s))
    s = _STROKE.sub(lambda m: ENTITY_STROKES[m[1]], _NAMED_ENTITY.sub(_entity, s))
    for bare in (" & ", "[&", ">&"):
        s = s.replace(bare, bare.replace("&", "&amp;"))
    return re.sub("&(?=c)", "&amp;", s)


@F.pandas_udf(StringType())
def unescape(c: pd.Series) -> pd.Series:
    return c.map(unescape_entities, na_action="ignore")
