"""Several values packed in one field: a parsing expression grammar for delimited lists.

Grammar, alternatives tried in the order given::

    field   <- number? item (separator number? item / blank number item)*
    item    <- (quoted / bracketed / and-or slash / bare character)*
    quoted  <- open body close / open body other-close &end / stray / open rest
    bracketed <- open inside close / open rest
    body    <- (doubled close / any character but close)*
    inside  <- (open body close / bracketed / any character but close)*
    stray   <- open &(blank / separator)
    separator <- [;,|·] / line break / tab / blank slash blank
    number  <- digits [.)] blank

An alternative that finds no end backtracks to where it began and the next is tried: a quote that is closed
as it should be; one closed by the mark of another kind before a separator or the end (flag
``mixed_quote``); one that stands alone before a blank or separator, an ordinary character (``stray_quote``); one in a
value that was cut, which hides the rest (``open_quote``).  A bracket without its end hides the rest
likewise (``open_bracket``).  A quote that opens inside a word is an ordinary character.  The first flag of a value
is kept.

Defined results: null, empty and blank-only values give no items; positions start at 1 and
skip empty items; items are trimmed of blanks of any kind; enclosing quotes are removed and
doubled ones inside them become single; very long values are parsed in linear time, for a quote that once
found no end is not searched again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: quote and bracket pairs, separators
QUOTES = {'"': '"', "“": "”", "‘": "’", "«": "»", "„": "“"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}
SEPARATORS = ";,|·\n\t\r"

_BLANK = r"[^\S\n\t\r]"
_NUMBER = re.compile(r"\s*\(?\d{1,3}[.)]\s+")
_NUMBER_INSIDE = re.compile(r"\s+\d{1,3}[.)]\s+")
_SLASH = re.compile(r"\s+/\s+")
_PLAIN = re.compile(r"[^;,|·\n\t\r\"“„‘«(\[{\s]+")
_QUOTED = {o: re.compile(f"{re.escape(o)}(?:{re.escape(c)}{re.escape(c)}|[^{re.escape(c)}])*+{re.escape(c)}") for o, c in QUOTES.items()}
# the blanks that the patterns above take, which are more than Java's \s
_JAVA_BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Values with none of these hold one item at most.
HINT = rf"[;,|·\n\t\r]|{_JAVA_BLANK}/{_JAVA_BLANK}|\p{{Nd}}[.)]{_JAVA_BLANK}"


_DOUBLE = '"“”„«»'
#: A closing mark of any double quote before a separator, a blank slash, a closing bracket or the end.
_OTHER_CLOSE = re.compile(r"(?<=[^\s;,|·])[\"”“»](?=\s*(?:[;,|·\n\t\r)\]]|\s/\s|$))")


def _bracketed(s: str, i: int, endless: set[str]) -> int:
    """End of the bracketed alternative at ``i``, or -1; ``endless``: quotes known to have no end from here on."""
    want = [BRACKETS[s[i]]]
    j, n = i + 1, len(s)
    while j < n:
        c = s[j]
        if c == want[-1]:
            want.pop()
            j += 1
            if not want:
                return j
            continue
        if c in BRACKETS:
            want.append(BRACKETS[c])
        elif c in QUOTES and c not in endless and not s[j - 1].isalnum():
            m = _QUOTED[c].match(s, j)
            if m:
                j = m.end()
                continue
            endless.add(c)
        j += 1
    return -1


def _quoted(s: str, i: int, endless: set[str]) -> tuple[int, str]:
    """(end, flag) of the first alternative that holds for the quote at ``i``; end ``i`` leaves it an ordinary character."""
    c = s[i]
    if c not in endless:
        m = _QUOTED[c].match(s, i)
        if m:
            return m.end(), ""
        endless.add(c)
    if c in _DOUBLE and "other" not in endless:
        m = _OTHER_CLOSE.search(s, i + 2)
        if m:
            return m.end(), "mixed_quote"
        endless.add("other")
    after = s[i + 1 : i + 2]
    if after and (after.isspace() or after in SEPARATORS):
        return i, "stray_quote"
    return len(s), "open_quote"


def _clean(item: str) -> str:
    item = item.strip()
    while len(item) > 1 and item[0] in QUOTES:
        m = _QUOTED[item[0]].fullmatch(item)
        if m:
            c = QUOTES[item[0]]
            item = item[1:-1].replace(c + c, c).strip()
        elif item[0] in _DOUBLE and item[-1] in _DOUBLE and not any(q in item[1:-1] for q in _DOUBLE):
            item = item[1:-1].strip()
        else:
            break
    return item


def parse(s: str | None) -> tuple[list[str], str]:
    """Items of one value and its flag: '', mixed_quote, stray_quote, open_quote or open_bracket."""
    if not s:
        return [], ""
    items: list[str] = []
    flag = ""
    n = len(s)
    m = _NUMBER.match(s)
    i = start = m.end() if m else 0
    endless: set[str] = set()

    def emit(end: int) -> None:
        item = _clean(s[start:end])
        if item:
            items.append(item)

    while i < n:
        m = _PLAIN.match(s, i)
        if m:
            i = m.end()
            if i >= n:
                break
        c = s[i]
        if c in SEPARATORS:
            emit(i)
            i += 1
            m = _NUMBER.match(s, i)
            i = start = m.end() if m else i
            continue
        if c in QUOTES and (i == 0 or not s[i - 1].isalnum()):
            end, found = _quoted(s, i, endless)
            flag = flag or found
            i = max(end, i + 1)
            continue
        if c in BRACKETS:
            j = _bracketed(s, i, endless)
            flag = flag or ("open_bracket" if j < 0 else "")
            i = j if j > 0 else n
            continue
        if c.isspace():
            m = _SLASH.match(s, i)
            if m:
                emit(i)
                i = start = m.end()
                continue
            m = _NUMBER_INSIDE.match(s, i)
            if m:
                emit(i)
                i = start = m.end()
                continue
        i += 1
    emit(n)
    return items, flag


_SCHEMA = "items array<string>, flag string"


def _parse_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [parse(x) for x in batch]
        yield pd.DataFrame({"items": [a for a, _ in out], "flag": [b for _, b in out]})


def parse_udf(c: Column) -> Column:
    return F.pandas_udf(_parse_typed, _SCHEMA)(c)


def _parse_typed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    yield from _parse_batches(batches)


def split_packed(df: DataFrame, value: str, keys: list[str], at_least: int = 1) -> DataFrame:
    """One row per item: the ``keys`` columns, item_pos, item, parse_flag.

    ``at_least``: only fields that hold so many items.  With 2, values without any separator
    character are dropped before they reach Python.
    """
    src = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{value}`").alias("packed_value"))
    src = src.where("packed_value is not null")
    if at_least > 1:
        src = src.where(F.col("packed_value").rlike(HINT))
    parsed = src.withColumn("parsed_value", parse_udf(F.col("packed_value")))
    return parsed.where(F.size("parsed_value.items") >= at_least).select(
        *[F.col(f"`{k}`") for k in keys],
        F.posexplode("parsed_value.items").alias("pos0", "item"),
        F.col("parsed_value.flag").alias("parse_flag"),
    ).select(*[F.col(f"`{k}`") for k in keys], (F.col("pos0") + 1).alias("item_pos"), "item", "parse_flag")
