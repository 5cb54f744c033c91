"""Transliteration between scripts and symbol composition, batch by batch through Arrow."""

from __future__ import annotations

import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ACUTE, GRAVE, CIRCUMFLEX = "́", "̀", "̂"
VIRAMA, UDATTA = "्", "॑"

# fixed values: the letters of one-letter-per-sound writing, romanization and Devanagari, in alphabetical order
VOWELS = (
    ("a", "a", "अ", ""), ("A", "ā", "आ", "ा"), ("i", "i", "इ", "ि"), ("I", "ī", "ई", "ी"), ("u", "u", "उ", "ु"), ("U", "ū", "ऊ", "ू"),
    ("f", "ṛ", "ऋ", "ृ"), ("F", "ṝ", "ॠ", "ॄ"), ("x", "ḷ", "ऌ", "ॢ"), ("X", "ḹ", "ॡ", "ॣ"),
    ("e", "e", "ए", "े"), ("E", "ai", "ऐ", "ै"), ("o", "o", "ओ", "ो"), ("O", "au", "औ", "ौ"),
)
CONSONANTS = (
    ("k", "k", "क"), ("K", "kh", "ख"), ("g", "g", "ग"), ("G", "gh", "घ"), ("N", "ṅ", "ङ"),
    ("c", "c", "च"), ("C", "ch", "छ"), ("j", "j", "ज"), ("J", "jh", "झ"), ("Y", "ñ", "ञ"),
    ("w", "ṭ", "ट"), ("W", "ṭh", "ठ"), ("q", "ḍ", "ड"), ("Q", "ḍh", "ढ"), ("R", "ṇ", "ण"),
    ("t", "t", "त"), ("T", "th", "थ"), ("d", "d", "द"), ("D", "dh", "ध"), ("n", "n", "न"),
    ("p", "p", "प"), ("P", "ph", "फ"), ("b", "b", "ब"), ("B", "bh", "भ"), ("m", "m", "म"),
    ("y", "y", "य"), ("r", "r", "र"), ("l", "l", "ल"), ("v", "v", "व"),
    ("S", "ś", "श"), ("z", "ṣ", "ष"), ("s", "s", "स"), ("h", "h", "ह"),
)
SIGNS = (("M", "ṃ", "ं"), ("H", "ḥ", "ः"), ("'", "'", "ऽ"), ("~", "m̐", "ँ"))

_TO_IAST = {a: b for a, b, *_ in (*VOWELS, *CONSONANTS, *SIGNS)}
_TO_SLP = {b: a for a, b in _TO_IAST.items()}
_INDEPENDENT = {a: d for a, _, d, _ in VOWELS}
_DEPENDENT = {a: d for a, _, _, d in VOWELS}
_LETTER = {a: d for a, _, d in CONSONANTS}
_SIGN = {a: d for a, _, d in SIGNS}
_DIGITS = {str(i): chr(0x966 + i) for i in range(10)}
_LONGEST = re.compile("|".join(sorted(map(re.escape, _TO_SLP), key=len, reverse=True)))


def slp1_to_iast(s: str) -> str:
    """Romanization with the high pitch as an acute, the other as a grave, and bars as stops."""
    out = "".join(_TO_IAST.get(c, c) for c in s)
    return out.replace("/", ACUTE).replace("^", GRAVE).replace("|", ".")


def iast_to_slp1(s: str) -> str:
    """Inverse of slp1_to_iast: pitch marks first, then the longest letters."""
    s = ud.normalize("NFC", s.replace(ACUTE, "/").replace(GRAVE, "^").replace(".", "|"))
    return _LONGEST.sub(lambda m: _TO_SLP[m[0]], s)


def slp1_to_deva(s: str) -> str:
    """Native script: a consonant keeps its vowel a unless another follows, then a sign or a stop."""
    s = re.sub(f"[/^{CIRCUMFLEX}]", "", s)
    out: list[str] = []
    bare = False
    for c in s:
        if c in _LETTER:
            if bare:
                out.append(VIRAMA)
            out.append(_LETTER[c])
            bare = True
            continue
        if c in _INDEPENDENT:
            out.append(_DEPENDENT[c] if bare else _INDEPENDENT[c])
            bare = False
            continue
        if bare:
            out.append(VIRAMA)
            bare = False
        out.append(_SIGN.get(c) or _DIGITS.get(c) or {"|": "।"}.get(c, c))
    if bare:
        out.append(VIRAMA)
    return "".join(out)


def iast_to_deva(s: str) -> str:
    plain = re.sub(f"[/^{ACUTE}{GRAVE}{CIRCUMFLEX}]", "", ud.normalize("NFD", s))
    plain = ud.normalize("NFC", plain)
    return re.sub("[᳐-᳟]", "", slp1_to_deva(_LONGEST.sub(lambda m: _TO_SLP[m[0]], plain)))


def restore_capitals(s: str) -> str:
    """Romanized letters at the start of a word or behind a hyphen back to their capital of one sound.

    The capital V of the source stays itself.
    """
    capital = {b: a for a, b in _TO_IAST.items() if a.isupper()}
    pattern = "|".join(sorted(map(re.escape, capital), key=len, reverse=True))
    return re.sub(rf"(^|-)({pattern})", lambda m: m[1] + capital[m[2]], s)


def accent_of(slp: str) -> tuple[str, int | None]:
    """(form without pitch marks, number of the accented vowel from 1, or none)."""
    n, accented = 0, None
    plain = []
    for c in slp:
        if c in _INDEPENDENT:
            n += 1
        if c == "/" and accented is None:
            accented = n or None
        if c not in "/^\\":
            plain.append(c)
    return "".join(plain), accented


_IAST_VOWEL = re.compile("|".join(sorted((b for _, b, *_ in VOWELS), key=len, reverse=True)))


def iast_accented(iast: str, n: int | None) -> str:
    """The n-th vowel with an acute, on the first letter of a diphthong's last part."""
    if not n:
        return iast
    for k, m in enumerate(_IAST_VOWEL.finditer(iast), 1):
        if k == n:
            return ud.normalize("NFC", iast[: m.end()] + ACUTE + iast[m.end() :])
    return iast


def deva_accented(slp: str, n: int | None) -> str:
    if not n:
        return slp1_to_deva(slp)
    k = 0
    for i, c in enumerate(slp):
        k += c in _INDEPENDENT
        if k == n and c in _INDEPENDENT:
            head = slp1_to_deva(slp[: i + 1]) + UDATTA
            tail = slp[i + 1 :]
            return head + (slp1_to_deva(tail) if tail else "")
    return slp1_to_deva(slp)


def with_accent(slp: str) -> tuple[str, str]:
    """(romanized, native) form with the accent of the one-letter form."""
    plain, n = accent_of(slp)
    return iast_accented(slp1_to_iast(plain), n), deva_accented(plain, n)


_MARKED = re.compile(r"<s>(.*?)</s>", re.S)


def spell_marked(entry: str) -> str:
    """Every <s>form</s> as 'romanized (native)'."""
    return _MARKED.sub(lambda m: f"{slp1_to_iast(m[1])} ({slp1_to_deva(m[1])})", entry)


def repair_gloss(gloss: str, forms: list[str]) -> str:
    """Captured forms written again from their romanization; forms are taken literally."""
    for f in forms:
        gloss = gloss.replace(f, f"{f} ({iast_to_deva(f)})")
    return gloss


# fixed values: Greek letters and their Roman writing, in alphabetical order
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "ē", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "ō",
}
ROUGH = "̔"


def greek_to_roman(s: str) -> str:
    """Letters by the table, rough breathing as h before the vowel or behind r, other marks off."""
    out: list[str] = []
    for c in ud.normalize("NFD", s):
        if c == ROUGH and out:
            if out[-1].lower() == "r":
                out[-1] += "h"
            else:
                out[-1] = ("H" + out[-1].lower()) if out[-1][0].isupper() else "h" + out[-1]
        elif ud.combining(c):
            continue
        else:
            roman = GREEK.get(c.lower(), c)
            out.append(roman.capitalize() if c.isupper() and c.lower() in GREEK else roman)
    s = "".join(out)
    return re.sub(r"g(?=g|k(?!h$)|kh|x)", "n", s)


def batch(f):
    """A scalar function as an Arrow function; nulls stay null."""

    @F.pandas_udf(StringType())
    def run(c: pd.Series) -> pd.Series:
        return c.map(f, na_action="ignore")

    return run


to_iast, to_slp1, to_deva, roman_to_deva, romanize_greek, spelled = (
    batch(f) for f in (slp1_to_iast, iast_to_slp1, slp1_to_deva, iast_to_deva, greek_to_roman, spell_marked)
)

# ------------------------------------------------------------------ composition of reconstructed symbols

# fixed values: modifiers with ready-made symbols, combining marks, appended letters
COMPOSED = {
    "acute": {"k": "ḱ", "g": "ǵ", "s": "ś"},
    "underdot": {"t": "ṭ", "d": "ḍ", "n": "ṇ", "r": "ṛ", "l": "ḷ", "s": "ṣ"},
    "macron": {"a": "ā", "e": "ē", "i": "ī", "o": "ō", "u": "ū"},
    "syllabic": {"r": "r̥", "l": "l̥", "m": "m̥", "n": "n̥"},
    "glide": {"i": "i̯", "u": "u̯"},
    "aspiration": {"b": "bʰ", "d": "dʰ", "g": "gʰ", "gʷ": "gʷʰ", "ǵ": "ǵʰ"},
    "labialization": {"k": "kʷ", "g": "gʷ"},
    "sub1": {"h": "h₁"},
    "sub2": {"h": "h₂"},
    "sub3": {"h": "h₃"},
}
MARKS = {"acute": "́", "underdot": "̣", "macron": "̄", "syllabic": "̥", "glide": "̯"}
APPENDED = {"aspiration": "ʰ", "labialization": "ʷ"}


def target_symbol(c: Column) -> Column:
    """Last letter, a labialized one with its mark; null for empty text."""
    return F.nullif(F.regexp_extract(c, "(?s).ʷ?$", 0), F.lit(""))


def _compose(symbol: str, key: str) -> str:
    ready = COMPOSED.get(key, {})
    base = ud.normalize("NFD", symbol)[:1]
    found = ready.get(symbol) or ready.get(base)
    if found:
        return found
    return symbol + (MARKS.get(key) or APPENDED.get(key) or "")


@F.pandas_udf(StringType())
def modify(left: pd.Series, key: pd.Series) -> pd.Series:
    """The text with a modifier applied to its last symbol; unknown modifiers change nothing."""

    def one(text, k):
        m = re.search(r"(?s).ʷ?$", text or "")
        return text if not m or k is None else text[: m.start()] + _compose(m[0], k)

    return pd.Series([one(a, b) for a, b in zip(left, key)], dtype="object")


def available(symbol: Column) -> Column:
    """Modifiers that make sense for a symbol: those with a ready form, and the combining ones."""
    base = F.substring(symbol, 1, 1)
    by_key = [F.when(base.isin(*{s[0] for s in ready}), F.lit(k)) for k, ready in COMPOSED.items()]
    return F.filter(F.array(*by_key), lambda x: x.isNotNull())


def merged_families(df, base: str, variants: str, order: list[str]):
    """(base, variants): the families of all languages under their base without trailing digits, first seen first."""
    from pyspark.sql import functions as G

    rows = df.select(G.regexp_replace(base, "[0-9]+$", "").alias("base"), *order, G.posexplode(variants).alias("at", "v"))
    first = rows.groupBy("base", "v").agg(G.min(G.struct(*order, "at")).alias("first"))
    return first.groupBy("base").agg(G.transform(G.array_sort(G.collect_list(G.struct("first", "v"))), lambda x: x["v"]).alias("variants"))
