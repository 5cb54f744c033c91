"""Per-document text statistics, and running prose told from lists, tables and junk.

A text is a row of *units*: its lines, and the parts of a line that packs many short parts between equal separators.
Tables and lists are detected from structure alone:

* vertical alignment: neighbouring units with the same delimiters, or with the same few words;
* indentation periodicity: units that open with a mark or are indented by multiples of one step;
* autocorrelation of unit lengths at lag one: ruled rows of one length.

The three are added in a window around each unit; the sum has to reach a bound, a lower one where units are
of a few words.  Units of many words and without strong delimiters are sentences or paragraphs: their marks do
not count.  What is not structured is read: long units are prose if word, symbol and capital ratios and the
share of common words say so, else junk; short units hold too few words for shares and are prose unless they are
noise, broken or repeated over and over.  A text is prose if most of its characters are.

Defined results: null and blank texts have zero words, null ratios and kind ``empty``; whole texts are read; repeated
documents get the same row each; rows and their other columns do not affect each other; any number of common
words is used, of which only those that texts may hold as a word count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMMON_SHARE, SINGLE_SHARE, TORN_SHARE, REPEATED, HALF = 0.15, 0.4, 0.12, 3, 0.5
#: Units of so many words are read; the sum of structure that makes a list or table, of units of few words and others.
LONG, FEW, BOUND_FEW, BOUND = 6, 3, 0.3, 0.6

_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
_MARK = re.compile(r"\s*(?:[-•*→–·+]\s+|\[[ xX]?\]\s+|\(?(?:\d{1,3}|[a-z]{1,4})[.)]\s+)")
# fixed values: characters that stand inside torn words, delimiters
_TORN = re.compile(r"[^\W\d_][#|~¦£�§¬^»«0-9$%&@<>=_]+[^\W\d_]|�|[#|~¦£§¬^][^\W\d_]|[^\W\d_][#|~¦£§¬^]|[¦~#£]")
_ODD = re.compile(r"[#|~¦£�§¬^»«0-9$%&@<>=_]")
_DIGIT = re.compile(r"\d")
#: Words in capitals are counted where two plain capitals stand together.
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]{2}")
_TAG = re.compile(r"</?\w+[^>]*>|&\w+;")
_STOP = re.compile(r"[.!?](?=\s|$|[\"'”)])")
_END = (".", "!", "?", ":", ";", "…", ".”", ".\"", ")")
_DELIMITER = re.compile(r"\t|\||[,;:]| {2,}|\.{4,}|-{4,}|={3,}| = ?")
STRONG = frozenset(("\t", "|", "  ", "..", "--", "==", " =", ",,"))
_SIGNS = ("\t", "|", "  ", "....", "----", "===", " =")
_SIMPLE = re.compile(r"[^\W\d_]+")
_COMBINING = re.compile(r"[̀-ͯ]")
#: Delimiters of units of many words, none of them strong: they align with nothing.
RUNNING = ("running",)

COLUMNS = (
    "n_words int, mean_word_len double, symbol_ratio double, digit_ratio double, upper_word_ratio double, "
    "common_word_ratio double, n_lines int, line_end_punct_ratio double, repeated_line_ratio double, "
    "alignment double, indent_period double, length_autocorr double, sentence_words double, prose_ratio double, kind string"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def units_of(line: str) -> list[str]:
    """The line, or its parts where many short ones stand between equal separators."""
    for sep in ("; ", ", ", " · "):
        n = line.count(sep) + 1
        if n >= 5 and line.count(" ") + 1 <= 3 * n:
            return [x for x in line.split(sep) if x.strip()]
    return [line]


def delimiters(unit: str, words: int) -> tuple[str, ...]:
    """Kinds of the delimiters inside a unit, in order; commas written tight are another kind and stand last."""
    tight = unit.count(",") - unit.count(", ") - unit.endswith(",") if "," in unit else 0
    if words > 8 and tight <= 0 and not any([x in unit for x in _SIGNS]):
        return RUNNING
    found = tuple([m[:2] for m in _DELIMITER.findall(unit)])
    return found + (",,",) * tight if tight > 0 else found


def alignment(marks: list[tuple[str, ...]], words: list[int]) -> list[float]:
    """1 for each pair of neighbours whose delimiters or few words stand alike, else 0."""
    out = []
    for a, b, m, n in zip(marks, marks[1:], words, words[1:]):
        if a is RUNNING or b is RUNNING:
            hit = False
        elif a == b:
            hit = (m == n and m <= 4 or max(m, n) <= 2) if not a else len(a) > 1 or a[0] in STRONG or max(m, n) < LONG
        else:
            # a rule and the row below it; rows with empty or joined cells: at least half of the strong delimiters in common
            x, y = Counter([k for k in a if k in STRONG]), Counter([k for k in b if k in STRONG])
            ruled = {"--", "=="}
            hit = bool(x and y) and (x.keys() <= ruled or y.keys() <= ruled or 2 * (x & y).total() >= max(x.total(), y.total()))
        out.append(1.0 if hit else 0.0)
    return out


def periodicity(units: list[str], marked: list[bool]) -> list[float]:
    """1 for units that open with a mark or are indented by a multiple of the step seen most, else 0."""
    indents = [len(x) - len(x.lstrip(" \t")) for x in units]
    steps = Counter(abs(a - b) for a, b in zip(indents, indents[1:]) if a != b)
    step = steps.most_common(1)[0][0] if steps else 0
    return [1.0 if m or (step and i and i % step == 0) else 0.0 for i, m in zip(indents, marked)]


def autocorrelation(lengths: list[int]) -> float:
    """Lag-one autocorrelation of lengths; 1 for units of one length."""
    n = len(lengths)
    if n < 3:
        return 0.0
    mean = sum(lengths) / n
    var = sum((x - mean) ** 2 for x in lengths)
    if var == 0:
        return 1.0
    return sum((a - mean) * (b - mean) for a, b in zip(lengths, lengths[1:])) / var


def _window(values: list[float], i: int, before: int, after: int) -> float:
    part = values[max(i - before, 0) : i + after]
    return sum(part) / len(part) if part else 0.0


def structured(marks: list[tuple[str, ...]], words: list[int], pairs: list[float], periods: list[float], auto: float) -> list[bool]:
    """Which units belong to a list or table by the structure around them."""
    out = []
    for i, (m, n) in enumerate(zip(marks, words)):
        if m is RUNNING:
            out.append(False)
            continue
        aligned = _window(pairs, i, 2, 2)
        few = _window(words, i, 2, 3) <= FEW
        score = aligned + (_window(periods, i, 2, 3) if n <= 8 else 0.0) + 0.5 * max(auto, 0.0)
        out.append(score >= (BOUND_FEW if few else BOUND))
    return out


def read_unit(rest: str, tokens: int, word: re.Pattern, common: frozenset[str]) -> tuple:
    """(words, letters, capitals, common, is prose, is noise) of one unit without its mark, taken by itself."""
    low = word.findall(rest.lower())
    k = len(low)
    lengths = list(map(len, low))
    n_letters = sum(lengths)
    hits = sum(map(common.__contains__, low))
    ups = sum([1 for w in word.findall(rest) if len(w) > 1 and w.isupper()]) if _CAPITALS.search(rest) else 0
    singles = lengths.count(1)
    torn = len(_TORN.findall(rest)) / tokens if _ODD.search(rest) else 0.0
    tag = len(_TAG.findall(rest)) if "<" in rest or "&" in rest else 0
    broken = torn >= TORN_SHARE or tag * 5 >= tokens or (k > 3 and singles >= SINGLE_SHARE * k) or n_letters > 30 * max(k, 1)
    if tokens >= LONG:
        prose = not broken and hits >= COMMON_SHARE * k and ups < 0.3 * k and 0 < k < 12 * len(set(low))
    else:
        prose = not broken and n_letters >= 0.6 * (len(rest) - rest.count(" "))
    return k, n_letters, ups, hits, prose, broken


def measure(text: str | None, common: frozenset[str]) -> tuple:
    if text is None or not text.strip():
        return (0, None, None, None, None, None, 0, None, None, None, None, None, None, None, "empty")
    lines = [x for x in text.split("\n") if x.strip()]
    bodies = [x.strip() for x in lines]
    seen = Counter(bodies)
    units: list[str] = []
    over: list[bool] = []
    for line, body in zip(lines, bodies):
        parts = units_of(line)
        units += parts
        over += [seen[body] > REPEATED] * len(parts)
    found = [_MARK.match(x) for x in units]
    rests = [x[m.end() :].strip() if m else x.strip() for x, m in zip(units, found)]
    words = [x.count(" ") + 1 if "  " not in x else len(x.split()) for x in rests]
    marks = [delimiters(x, n) for x, n in zip(rests, words)]
    word = _WORD if _COMBINING.search(text) else _SIMPLE
    pairs, periods = alignment(marks, words), periodicity(units, [m is not None for m in found])
    auto = autocorrelation([len(x) for x in units])
    in_structure = structured(marks, words, pairs, periods, auto)
    words_all = letters = upper = common_all = chars = prose = listed = tabled = junk = 0
    known: dict[str, tuple] = {}
    for rest, tokens, m, again, inside in zip(rests, words, marks, over, in_structure):
        n = max(len(rest), 1)
        chars += n
        if rest not in known:
            known[rest] = read_unit(rest, tokens, word, common)
        k, n_letters, ups, hits, is_prose, broken = known[rest]
        words_all += k
        letters += n_letters
        upper += ups
        common_all += hits
        strong = m is not RUNNING and not STRONG.isdisjoint(m)
        if inside and (strong or not (broken or again)):
            if strong:
                tabled += n
            else:
                listed += n
        elif is_prose and not again:
            prose += n
        else:
            junk += n
    ended = sum(body.endswith(_END) for body in bodies)
    repeated = sum(n for n in seen.values() if n > REPEATED)
    solid = sum(map(len, text.split()))
    digits = len(_DIGIT.findall(text))
    # what is neither letter nor digit, list marks included
    symbols = max(solid - letters - digits, 0)
    per_sentence = words_all / max(len(_STOP.findall(text)), 1)
    ratio = prose / chars
    # words without sentences, and words of digits
    if (ratio >= HALF and words_all > 40 and per_sentence > 90) or (ratio >= HALF and digits > 0.4 * solid):
        ratio, junk = 0.0, chars
    if ratio >= HALF:
        kind = "prose"
    elif junk >= max(listed, tabled):
        kind = "junk"
    else:
        kind = "table" if tabled >= listed else "list"
    aligned = sum(pairs) / len(pairs) if pairs else 0.0
    return (
        words_all, letters / words_all if words_all else None, symbols / solid, digits / solid,
        upper / words_all if words_all else None, common_all / words_all if words_all else None, len(lines), ended / len(lines),
        repeated / len(lines), aligned, sum(periods) / len(periods), auto, per_sentence, ratio, kind,
    )


def common_words(words: DataFrame, column: str = "word") -> frozenset[str]:
    """The list of common words, lower case; a table of the language, not of the documents."""
    return frozenset(r["w"] for r in words.where(F.col(column).isNotNull()).select(F.lower(F.col(column)).alias("w")).distinct().collect())


def statistics(df: DataFrame, doc_id: str, text: str, common: frozenset[str]) -> DataFrame:
    """doc_id with all statistics of COLUMNS; one row per input row."""
    kind = df.schema[doc_id].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([measure(t, common) for t in batch["t"]], columns=NAMES)
            for c in ("n_words", "n_lines"):
                out[c] = out[c].astype("int32")
            out.insert(0, "k", batch["k"].to_numpy())
            yield out

    src = df.select(F.col(f"`{doc_id}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return src.mapInPandas(rows, f"k {kind}, {COLUMNS}").withColumnRenamed("k", doc_id)
