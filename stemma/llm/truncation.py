"""Text cut off by field limits or in transfer, found by a model trained on artificial cuts.

1. The length limit of every source is read from all values: the longest length (in characters
   or bytes, a closing replacement character left out) at which values pile up.
2. Intact values (closed by their fuller text, by punctuation, or well below any limit) are cut artificially: at
   limits like those found, in characters or in bytes, where bytes may tear a character, and at hashed
   places, as in transfer.  A cut inside a word, phrase, bracket or list is a positive, one that leaves out whole
   last items and the values themselves are negatives.  The length to the limit is measured on every
   example against the limit it was cut at or fits below, as on every real value.
3. A hashed logistic regression is fitted on closing characters, closing words, punctuation balance, length
   to limit as a number and in steps, whether the closing word occurs elsewhere inside texts, and how the value
   compares with a fuller text of the same row.  Training begins at plain weights for brackets, quotes and
   limits, which stay where there is nothing to learn from.  The sample is bounded by ``max_train`` intact values a
   field, taken by hash order; counts, limits and scores cover every row.

Defined results: null and blank values are never cut; texts closed by an ellipsis or 'etc.' are
complete; a closing replacement character is a cut character; equal rows get equal scores; fields without
a ``Field`` description are taken as lists without fuller text.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.session import broadcast_if_small, cut

DIM = 1 << 16
SEPARATORS = ";,|·\n\t"
FAR = -1  # no limit
#: Share of cut values that the examples are weighed to.
CUT_SHARE = 0.15
_ENDS = SEPARATORS + " \u00a0"
_PAIRED = re.compile(r"[()\[\]\"“”‘’«»']")
_BREAK = re.compile(r"[;,|·\n\t]|[./](?=[ \xa0])")
_TAIL_WORD = re.compile(r"[^\s,;|·/()\[\]\"“”‘’«»]+$")
_CLOSED = re.compile(r"(?:…|\.\.\.|\betc\.?)\s*$")
_NUMBERED = re.compile(r"(?:^|\s)\d{1,3}\)")
_SINGLE = re.compile(r"(?:^|(?<=[\s(]))'|'(?=$|[\s,.;)!?])")
_GOES_ON = re.compile(r"\s*[;,|·\n\t]|\s/\s|\.\s|\.?$")
BETWEEN_WORDS = r"\s\u00a0,;|·/()\[\]\"“”‘’«»"


@dataclass(frozen=True)
class Field:
    """What the values of a field are.

    ref: how the fuller text of the row holds the value: its ``item``s, as its ``prefix``, or ``none``.
    prose: sentences, which a stop or a closing bracket shows to be whole.
    forms: a list of forms of one word, in which more has to follow a separator.
    """

    ref: str = "none"
    prose: bool = False
    forms: bool = False


def last_item(v: str) -> str:
    """What follows the last separator outside brackets and double quotes."""
    n = len(v.rstrip())
    depth, quote, start = 0, False, 0
    if not _PAIRED.search(v):
        for m in _BREAK.finditer(v, 0, n):
            if m.end() < n:
                start = m.end()
        return v[start:]
    for i, c in enumerate(v):
        if c in "([":
            depth += 1
        elif c in ")]":
            depth = max(0, depth - 1)
        elif c in "\"“”«»":
            quote = not quote
        elif not quote and not depth and (c in SEPARATORS or (c in "./" and v[i + 1 : i + 2] in (" ", "\xa0"))):
            if i + 1 < n:
                start = i + 1
    return v[start:]


def _open(v: str) -> tuple[bool, bool]:
    if not _PAIRED.search(v):
        return False, False
    bracket = _NUMBERED.sub(" ", v) if ")" in v else v
    b = bracket.count("(") > bracket.count(")") or bracket.count("[") > bracket.count("]")
    q = v.count('"') % 2 == 1 or v.count("“") > v.count("”") or v.count("«") > v.count("»") or v.count("‘") > v.count("’")
    return b, q or ("'" in v and len(_SINGLE.findall(v)) % 2 == 1)


def compare(v: str, ref: str | None, kind: str, item: str | None = None) -> str:
    """'none', 'whole' or 'more': how the end of ``v``, its last item, stands in the fuller text."""
    if not ref or kind == "none":
        return "none"
    if kind == "prefix":
        if not ref.startswith(v):
            return "none"
        rest = ref[len(v) :]
        if not rest or (re.match(r"\s*[;,=]|\s+=", rest) and v[-1:].isalnum() or (rest[:1] in ",;" and v[-1:] in ").")):
            return "whole"
        return "more"
    item = last_item(v.rstrip(_ENDS)) if item is None else item
    item = item.strip().strip("\"“”‘’«»").strip()
    if item[:1].isdigit():
        item = re.sub(r"^\d{1,3}[.)]\s+", "", item)
    item = item.replace("�", "").strip()
    if not item:
        return "none"
    found, at = "none", ref.find(item)
    while at >= 0:
        if at == 0 or (at > 1 and ref[at - 1] == " " and ref[at - 2] in ";,."):
            end = at + len(item)
            if end == len(ref) or ref[end] in ";,":
                return "whole"
            found = "more"
        at = ref.find(item, at + 1)
    return found


def _h(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) % (DIM - 64) + 64


def step_of(distance: int) -> int:
    """Step of the length to the limit: exact below 3, then in widening steps; the last where there is none."""
    if distance < 0:
        return 6
    return distance if distance < 3 else 3 if distance < 9 else 4 if distance < 33 else 5


def nearness(distance: int) -> float:
    """Length to the limit as a number between 0 (far or no limit) and 1 (at it)."""
    return 1.0 / (1 + distance) if distance >= 0 else 0.0


#: Number of features of a value, and the first of the fixed ones: limit steps.
N_FEATURES, STEPS = 22, 20


def features(name: str, spec: Field, v: str, ref: str | None, distance: int, known: int, closes: int) -> list[int]:
    s = v.rstrip()
    tail = len(v) > len(s)
    b, q = _open(v)
    whole_item = last_item(s)
    words = whole_item.split()
    lead = " ".join(words[:2])
    m = _TAIL_WORD.search(s)
    word = m.group().lower() if m else ""
    close = s[-1:] if s[-1:] and not s[-1:].isalnum() else "A"
    stray = close in SEPARATORS
    cmp_ = compare(v, ref, spec.ref, None if stray else whole_item)
    step = step_of(distance)
    p = name + "|"
    few = min(len(words), 12)
    return [
        0, 1 + b, 3 + q, STEPS + step, 7 + min(known, 3), 11 + ("none", "whole", "more").index(cmp_), 14 + (close == "�"),
        16 + (_CLOSED.search(s) is not None), 30 + stray + 2 * tail,
        _h(p + "close" + close), _h(p + "cmp" + cmp_), _h(f"{p}lim{step}{close == 'A'}{known > 0}"), _h(f"{p}sep{stray}{tail}"),
        _h(p + "w" + word), _h(p + "w2" + " ".join(words[-2:]).lower()), _h(p + "w3" + " ".join(words[-3:]).lower()),
        _h(p + "lw" + lead + "|" + word), _h(f"{p}ln{words[0] if words else ''}|{few}|{close}"), _h(f"{p}l2n{lead}|{few}|{min(known, 3)}"),
        34 + closes, _h(f"{p}cl{closes}|{close}|{few}"), _h(f"{p}cn{closes}|{words[0] if words else ''}|{step}"),
    ]


def prior() -> np.ndarray:
    """Plain weights: no cut; open bracket or quote, unknown last word, torn character, whole or longer fuller text; the last is nearness."""
    w = np.zeros(DIM + 1)
    w[[0, 2, 4, 7, 12, 13, 15, 17]] = -2, 4, 3, 1.5, -4, 4, 6, -6
    w[DIM] = 1.5
    return w


def _untorn(value: str) -> Column:
    """The value without a closing replacement character, which is longer than the torn bytes it stands for."""
    return F.regexp_replace(value, "\ufffd+$", "")


def limits(values: DataFrame) -> DataFrame:
    """(field, source_key, max_chars, max_bytes): the longest length where values pile up, else null.

    A few values may lie above a limit, if its pile stands out from the neighbouring lengths.  In bytes only
    values with longer characters tell: the others pile up at a limit in characters just as well.
    """
    lengths = values.select("field", "source_key", F.length(_untorn("value")).alias("chars"), F.octet_length(_untorn("value")).alias("bytes"))
    source = Window.partitionBy("field", "source_key")
    longer = source.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    near = source.orderBy("n").rangeBetween(-3, 3)
    out = None
    for unit in ("chars", "bytes"):
        own = F.lit(True) if unit == "chars" else F.col("bytes") > F.col("chars")
        hist = lengths.groupBy("field", "source_key", F.col(unit).alias("n")).agg(F.count(F.lit(1)).alias("c"), F.count_if(own).alias("own"))
        hist = hist.select("*", F.sum("c").over(source).alias("all"), F.count(F.lit(1)).over(source).alias("lengths"), F.coalesce(F.sum("c").over(longer), F.lit(0)).alias("above"), (F.sum("c").over(near) - F.col("c")).alias("near"))
        few_above = (F.col("above") == 0) | ((F.col("above") * 10 <= F.col("own")) & (F.col("c") * 3 >= F.col("near") * 2))
        # the end of an unlimited distribution holds single values; a limit holds a pile
        pile = few_above & (F.col("c") >= 4) & (F.col("c") * F.col("lengths") >= 1.5 * F.col("all") * F.least(F.lit(1.0), 4.0 * F.col("c") / F.col("all") + 0.2))
        hist = hist.withColumn("pile", F.coalesce(pile, F.lit(False)))
        # sources whose longest values share one length with piles elsewhere have the same field limit
        longest = hist.where("pile").groupBy("field", "source_key").agg(F.max("n").alias("n"))
        shared = longest.groupBy("field", "n").agg(F.count(F.lit(1)).alias("piles")).where("piles >= 2")
        limited = F.col("pile") | (F.col("piles").isNotNull() & few_above & (F.col("c") >= 2))
        got = hist.join(shared, ["field", "n"], "left").groupBy("field", "source_key").agg(F.max(F.when(limited, F.col("n"))).alias(f"max_{unit}"))
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    # unlike a join, grouping keeps the source that is null
    return out.groupBy("field", "source_key").agg(F.max("max_chars").alias("max_chars"), F.max("max_bytes").alias("max_bytes"))


def _last_word(value: str) -> Column:
    """What stands behind the last separator, lower case and without closing stops; empty where nothing does."""
    return F.rtrim(F.element_at(F.split(F.rtrim(F.lower(value)), f"[{BETWEEN_WORDS}]"), -1), F.lit(".'"))


def vocabulary(values: DataFrame) -> DataFrame:
    """(word, seen, ends): how often a word has other text behind it, so that no cut can have touched it, and how often it ends a value."""
    parts = values.select(F.split(F.lower("value"), f"[{BETWEEN_WORDS}.]+").alias("p"), _last_word("value").alias("last"))
    before = F.size("p") - F.when(F.element_at("p", -1) == "", 2).otherwise(1)
    # the last word stands behind a sign no text has, so that one list holds both
    words = parts.select(F.explode(F.concat(F.slice("p", F.lit(1), F.greatest(before, F.lit(0))), F.array(F.concat(F.lit("\u0002"), "last")))).alias("word"))
    words = words.select(F.ltrim("word", F.lit("\u0002")).alias("word"), F.col("word").startswith("\u0002").cast("int").alias("last"))
    return (
        words.where("word <> ''")
        .groupBy("word")
        .agg(F.sum(1 - F.col("last")).alias("seen"), F.sum("last").alias("ends"))
        .where("seen >= 2 or ends >= 5")
    )


def _with_known(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``known``: how often the last word stands inside texts, 0 to 3, and ``closes``: how readily it ends them, 0 (rare word) to 5."""
    seen, ends = F.coalesce("__seen", F.lit(0)), F.coalesce("__ends", F.lit(0))
    level = F.when(seen >= 20, 3).when(seen >= 5, 2).when(seen >= 2, 1).otherwise(0)
    rate = ends / (seen + ends)
    closing = F.when(seen + ends < 8, 0).when(rate < 0.01, 1).when(rate < 0.05, 2).when(rate < 0.2, 3).when(rate < 0.5, 4).otherwise(5)
    # values without a last word meet nothing; a key of their own keeps them from meeting in one task
    df = df.withColumn("__tail", _last_word("value")).withColumn("__key", F.when(F.col("__tail") == "", F.concat(F.lit("\u0001"), F.xxhash64("value").cast("string"))).otherwise(F.col("__tail")))
    df = df.join(vocab.select(F.col("word").alias("__word"), F.col("seen").alias("__seen"), F.col("ends").alias("__ends")), F.col("__key") == F.col("__word"), "left")
    df = df.withColumn("known", F.when(F.col("__tail") == "", 2).otherwise(level)).withColumn("closes", F.when(F.col("__tail") == "", 0).otherwise(closing))
    return df.drop("__tail", "__key", "__word", "__seen", "__ends")


# ------------------------------------------------------------------ artificial cuts


def _size(v: str, unit: str) -> int:
    return len(v) if unit == "chars" else len(v.encode("utf-8", "replace"))


def _distance(v: str, limit: tuple[str, int] | None) -> int:
    """Length to a limit, without a closing replacement character; FAR without one or beyond it."""
    if limit is None:
        return FAR
    d = limit[1] - _size(v.rstrip("\ufffd"), limit[0])
    return d if d >= 0 else FAR


def _shortened(v: str, unit: str, limit: int, keep_torn: bool) -> str:
    if unit == "chars":
        return v[:limit]
    return v.encode("utf-8", "replace")[:limit].decode("utf-8", "replace" if keep_torn else "ignore")


def _label(full: str, v: str, spec: Field) -> int | None:
    """1 if ``v`` stops inside something, 0 if it leaves out whole last items, None where that cannot be told."""
    rest = full[len(v.rstrip("\ufffd")) :]
    if v[-1:] == "\ufffd":
        return 1
    stray = v[-1:] in _ENDS or v[-1:] == "/"
    if not rest or (stray and not spec.forms):
        return None
    if any(_open(v)):
        return 1
    return 0 if _GOES_ON.match(rest) and not stray else 1


def artificial(full: str, spec: Field, limits: list[tuple[str, int]], seed: int) -> list[tuple[str, int, int]]:
    """(value, length to limit, label) made of one intact value."""
    rnd = random.Random(seed)
    fits = [x for x in limits if _size(full, x[0]) <= x[1]]
    own = rnd.choice(fits) if fits else None
    # a complete value may fill its field to the last place
    if fits and rnd.random() < 0.06:
        own = (own[0], _size(full, own[0]))
    out = [(full, _distance(full, own), 0)]
    bare = full.rstrip()
    if spec.prose and bare.endswith("."):
        out.append((bare[:-1], _distance(bare[:-1], own), 0))
    if not spec.prose and not spec.forms:
        if rnd.random() < 0.3:
            stray = full + rnd.choice((",", ";", " ;", "; "))
            out.append((stray, _distance(stray, own), 0))
        # single items and beginnings that leave out whole items
        breaks = [] if _PAIRED.search(full) else [m.start() for m in re.finditer(r"[;,|·\n\t]", full)]
        if breaks:
            at = rnd.choice(breaks)
            for part in (full[breaks[-1] + 1 :].strip(), full[:at].strip()):
                if part and rnd.random() < 0.5:
                    out.append((part, _distance(part, own), 0))
    short = [x for x in limits if 2 <= x[1] < _size(full, x[0])]
    made = [(_shortened(full, *x, rnd.random() < 0.7), x) for x in rnd.sample(short, min(2, len(short)))]
    made += [(full[: rnd.randint(2, len(full) - 1)], own) for _ in range(2 if len(full) > 3 else 0)]
    for v, limit in made:
        label = _label(full, v, spec)
        if label is not None and v.strip():
            out.append((v, _distance(v, limit), label))
    return out


def examples(values: DataFrame, lim: DataFrame, fields: dict[str, Field], max_train: int) -> DataFrame:
    """(field, value, ref, distance, label, part): intact values and their artificial cuts.

    Limits to cut at: those found in the sources of the field, and lengths that a half, a quarter and a tenth of
    its values exceed.
    """
    known = [lim.where(f"max_{u} is not null").groupBy("field", F.col(f"max_{u}").alias("n")).agg(F.count(F.lit(1)).alias("c")).withColumn("unit", F.lit(u)) for u in ("chars", "bytes")]
    top = Window.partitionBy("field").orderBy(F.desc("c"), "unit", "n")
    rows = known[0].unionByName(known[1]).withColumn("r", F.row_number().over(top)).where("r <= 20").collect()
    sizes = values.groupBy("field").agg(*[F.percentile_approx(x, [0.5, 0.75, 0.9], 1000).alias(u) for u, x in (("chars", F.length("value")), ("bytes", F.octet_length("value")))]).collect()
    limits: dict[str, list[tuple[str, int]]] = {}
    for r in rows:
        limits.setdefault(r["field"], []).append((r["unit"], r["n"]))
    for r in sizes:
        limits.setdefault(r["field"], []).extend((u, n) for u in ("chars", "bytes") for n in r[u])
    prose = [k for k, f in fields.items() if f.prose]
    # by its fuller text, by its end, or, where there is neither, far below any limit
    spec = lambda name: fields.get(name, Field())
    no_ref = [k for k, f in fields.items() if f.ref == "none"]
    away = (F.col("distance") < 0) | (F.col("distance") > 8)
    ended = F.when(F.col("field").isin(prose), F.col("value").rlike(r"[.…)]\s*$")).otherwise(F.col("field").isin(no_ref) | ~F.col("field").isin(list(fields)) | F.col("ref").isNotNull())
    whole = values.where((F.length("value") >= 4) & away & ended)
    w = Window.partitionBy("field", "bucket").orderBy("h")
    picked = whole.withColumn("h", F.xxhash64("field", "value")).withColumn("bucket", F.pmod("h", F.lit(64)))
    picked = picked.dropDuplicates(["field", "value"]).withColumn("r", F.row_number().over(w)).where(F.col("r") <= max(max_train // 64, 1))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, v, ref, h in zip(b["field"], b["value"], b["ref"], b["h"]):
                f, ref = spec(name), ref if isinstance(ref, str) else None
                if f.ref != "none" and ref is not None and compare(v, ref, f.ref) != "whole":
                    continue
                for i, (x, d, label) in enumerate(artificial(v, f, limits.get(name, []), int(h))):
                    # most values have no fuller text, so part of the examples goes without
                    shown = ref if zlib.crc32(f"{h}|{i}".encode()) % 100 < 45 else None
                    out.append((name, x, shown, d, label, int(h) % 10))
            yield pd.DataFrame(out, columns=["field", "value", "ref", "distance", "label", "part"])

    return picked.select("field", "value", "ref", "h").mapInPandas(make, "field string, value string, ref string, distance int, label int, part int")


# ------------------------------------------------------------------ model


def fit(x: np.ndarray, near: np.ndarray, y: np.ndarray, epochs: int = 14, rate: float = 0.3, l2: float = 1e-5) -> np.ndarray:
    """AdaGrad from the plain weights; x holds indices of binary features, one row an example, near the nearness to the limit."""
    start = prior()
    weights, squares = start.copy(), np.full(DIM + 1, 1e-2)
    order = np.random.default_rng(7)
    n = len(y)
    # far more values are whole than cut
    balance = np.where(y == 1, CUT_SHARE * n / max(y.sum(), 1), (1 - CUT_SHARE) * n / max(n - y.sum(), 1))
    for _ in range(epochs if n else 0):
        idx = order.permutation(n)
        for a in range(0, n, 256):
            b = idx[a : a + 256]
            z = weights[x[b]].sum(axis=1) + weights[DIM] * near[b]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) * balance[b] / len(b) * 16
            flat = x[b].ravel()
            grad = np.bincount(flat, np.repeat(g, x.shape[1]), DIM + 1)
            grad[DIM] = g @ near[b]
            touched = np.append(np.unique(flat), DIM)
            grad = grad[touched] + l2 * (weights[touched] - start[touched])
            squares[touched] += grad**2
            weights[touched] -= rate * grad / np.sqrt(squares[touched])
    return weights


INPUTS = ("field", "value", "ref", "distance", "known", "closes")


def _matrix(b: pd.DataFrame, fields: dict[str, Field]) -> tuple[np.ndarray, np.ndarray]:
    rows = [
        features(name, fields.get(name) or Field(), v, ref if isinstance(ref, str) else None, d, k, c)
        for name, v, ref, d, k, c in zip(*[b[x].tolist() for x in INPUTS])
    ]
    return np.array(rows, dtype=np.int64).reshape(-1, N_FEATURES), np.array([nearness(d) for d in b["distance"].tolist()])


def train(values: DataFrame, lim: DataFrame, vocab: DataFrame, fields: dict[str, Field], max_train: int = 6_400) -> tuple[np.ndarray, float]:
    """(weights, held-out accuracy on artificial cuts); a tenth of the values is held out.

    Without examples the plain weights stay.
    """
    made = _with_known(examples(values, lim, fields, max_train), vocab).toPandas()
    x, near = _matrix(made, fields)
    y, held = made["label"].to_numpy(float), made["part"].to_numpy() == 0
    weights = fit(x[~held], near[~held], y[~held])
    guess = weights[x[held]].sum(axis=1) + weights[DIM] * near[held] > 0
    return weights, float((guess == y[held]).mean()) if held.any() else float("nan")


def not_blank(values: DataFrame) -> DataFrame:
    return cut(values.where(F.length(F.trim("value")) > 0))


def prepare(values: DataFrame, lim: DataFrame) -> DataFrame:
    """Add distance: the length to the limit of the source, -1 without or beyond one.  lim: of ``limits``."""
    known = lim.toDF("__field", "__source", "__chars", "__bytes")
    joined = values.join(known, (F.col("field") == F.col("__field")) & F.col("source_key").eqNullSafe(F.col("__source")), "left")
    left = [F.col("__chars") - F.length(_untorn("value")), F.col("__bytes") - F.octet_length(_untorn("value"))]
    distance = F.least(*[F.when(x >= 0, x) for x in left])
    return joined.withColumn("distance", F.coalesce(distance, F.lit(FAR)).cast("int")).drop("__field", "__source", "__chars", "__bytes")


def score(values: DataFrame, fields: dict[str, Field], max_train: int = 6_400) -> tuple[DataFrame, float]:
    """(values with ``probability`` that they were cut, held-out accuracy).  values: field, source_key, value, ref and others."""
    kept = not_blank(values)
    lim = broadcast_if_small(limits(kept))
    ready = prepare(kept, lim)
    vocab = broadcast_if_small(vocabulary(kept))
    weights, held_out = train(ready, lim, vocab, fields, max_train)
    shared = values.sparkSession.sparkContext.broadcast(weights)

    def rows(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        w = shared.value
        for columns in batches:
            x, near = _matrix(pd.DataFrame(dict(zip(INPUTS, columns))), fields)
            z = w[x].sum(axis=1) + w[DIM] * near
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    rows.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    probability = F.pandas_udf(rows, "double")
    return _with_known(ready, vocab).withColumn("probability", probability(*INPUTS)), held_out
