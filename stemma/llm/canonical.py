"""Free-typed values to entries of a reference list by token repair and soft TF-IDF.

1. The reference list becomes a vocabulary of *forms*: listed spellings, names, and spellings derived from them.
   How spellings are derived is read off the list itself: a prefix that sets a staged member of a family
   ("Old X") apart from the plain one in several families, an ending that several entries show beside a spelling
   without it.  Lists of any size: rules are counted over all entries by joins and sums, forms are made family by
   family, and the vocabulary is broadcast only if it is measured to be small.
2. Every distinct value is cleaned, split into phrases at hard separators and into tokens.
3. Every distinct token of ``MIN_REPAIR`` letters or more is joined with the vocabulary words by edit distance: both
   sides list their one-letter deletions (beyond ``LONG`` letters their first and last letters, of which one edit
   leaves one untouched), equal keys meet in an equi-join, and the pair is verified.  In shorter tokens an edit
   makes another word, so they have to be equal.
4. Corrected tokens are combined: a form counts when all its words were met; it is ranked by
   soft TF-IDF, the share of its weight (inverse document frequency times word similarity) that was
   met; of the forms covering one token the longest, then the highest ranked, wins.

Defined results: null values are no cases; blank or unreadable values map to nothing (id 0); ties go
to the smallest entry id; a value naming several entries gives one row each; an empty reference list
maps nothing; texts and tokens may have any length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemma.session import broadcast_if_small, cut

MIN_REPAIR, LONG = 4, 40


@dataclass(frozen=True)
class Rules:
    """prefixes: word of a full name -> prefixes of spellings; endings: what spellings may end in besides."""

    prefixes: dict[str, tuple[str, ...]] = field(default_factory=dict)
    endings: tuple[str, ...] = ()


def _plain(s: str) -> str:
    return s.strip().strip(".").strip().lower()


def _umlauts(w: str) -> set[str]:
    out = {w}
    for a, b, c in (("ä", "a", "ae"), ("ö", "o", "oe"), ("ü", "u", "ue")):
        out |= {x.replace(a, b) for x in out} | {x.replace(a, c) for x in out}
    return out


Entry = tuple[int, "str | None", "str | None", "str | None"]


def _spellings(s: str | None) -> list[str]:
    return [x for x in map(_plain, (s or "").split(",")) if x]


def _endings(own: list[str]) -> Iterator[str]:
    """What one spelling of an entry has behind another one."""
    for x in own:
        for y in own:
            if y != x and y.startswith(x) and len(y) - len(x) > 2:
                yield y[len(x) :]


def _shortest(endings: set[str]) -> tuple[str, ...]:
    """Endings that end in no other one."""
    return tuple(e for e in sorted(endings) if not any(e[i:] in endings for i in range(1, len(e))))


def _bare(s: str, endings: tuple[str, ...]) -> str:
    return next((s.removesuffix(e) for e in endings if s.endswith(e)), s)


def _rules(seen: dict[tuple[str, str], int], endings: tuple[str, ...], least: int) -> Rules:
    """seen: word of a full name and prefix -> number of families."""
    prefixes: dict[str, list[str]] = defaultdict(list)
    for (stage, p), n in sorted(seen.items(), key=lambda kv: (-kv[1], kv[0])):
        if n >= least:
            prefixes[stage].append(p)
    return Rules({k: tuple(v) for k, v in prefixes.items()}, endings)


def learn(entries: list[Entry], least: int = 3) -> Rules:
    """Prefixes and endings that at least ``least`` families show; of endings the shortest that end alike."""
    plain: dict[str, set[str]] = defaultdict(set)
    staged: list[tuple[str, str, list[str]]] = []
    endings: dict[str, set[str]] = defaultdict(set)
    for _, _, spellings, full in entries:
        own, words = _spellings(spellings), _plain(full or "").split()
        if len(words) == 1:
            plain[words[0]] |= set(own) | {words[0]}
        elif len(words) == 2:
            staged.append((words[0], words[1], own))
        for e in _endings(own):
            endings[e].add(words[-1] if words else "")
    common = _shortest({e for e, bases in endings.items() if len(bases) >= least})
    seen: dict[tuple[str, str], set[str]] = defaultdict(set)
    for stage, base, own in staged:
        stems = {_bare(y, common) for y in plain.get(base, ()) if len(_bare(y, common)) > 2}
        for x in (_bare(x, common) for x in own):
            for y in stems:
                if x.endswith(y) and len(x) > len(y):
                    seen[stage, x[: -len(y)]].add(base)
    return _rules({k: len(bases) for k, bases in seen.items()}, common, least)


def learn_all(rows: DataFrame, least: int = 3) -> Rules:
    """What ``learn`` finds in a table (e, short, spellings, full): its entries are met by joins, only the rules come together."""
    text = lambda x: x if isinstance(x, str) else None

    def read(b: pd.DataFrame) -> Iterator[tuple[list[str], list[str]]]:
        for spellings, full in zip(b["spellings"], b["full"]):
            yield _spellings(text(spellings)), _plain(text(full) or "").split()

    def endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(e, words[-1] if words else "") for own, words in read(b) for e in _endings(own)], columns=["ending", "base"])

    often = rows.mapInPandas(endings, "ending string, base string").groupBy("ending").agg(F.count_distinct("base").alias("n")).where(F.col("n") >= least)
    common = _shortest({r["ending"] for r in often.collect()})

    def spelt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Spellings without their endings; of plain entries stage is null."""
        for b in batches:
            out = []
            for own, words in read(b):
                if len(words) == 1:
                    out += [(None, words[0], _bare(y, common)) for y in {*own, words[0]}]
                elif len(words) == 2:
                    out += [(words[0], words[1], _bare(x, common)) for x in own]
            yield pd.DataFrame(out, columns=["stage", "base", "x"])

    known = cut(rows.mapInPandas(spelt, "stage string, base string, x string").distinct())
    plain = known.where("stage is null and length(x) > 2").select("base", F.col("x").alias("y"))
    met = known.where("stage is not null").join(plain, "base").where(F.endswith("x", "y") & (F.length("x") > F.length("y")))
    met = met.select("stage", F.expr("left(x, length(x) - length(y))").alias("p"), "base")
    seen = met.groupBy("stage", "p").agg(F.count_distinct("base").alias("n")).where(F.col("n") >= least).collect()
    return _rules({(r["stage"], r["p"]): r["n"] for r in seen}, common, least)


def forms_of(entries: list[Entry], rules: Rules | None = None, names: dict[str, str] | None = None) -> list[tuple[str, int, float]]:
    """(form, entry id, trust) of entries (id, short name, comma list of spellings, full name).

    names: further spellings, each by a listed spelling of the same entry.
    """
    rules = learn(entries) if rules is None else rules
    forms: dict[str, tuple[float, int]] = {}

    def add(form: str, entry: int, trust: float) -> None:
        for f in _umlauts(form):
            t = trust if f == form else trust - 0.01
            if f and (f not in forms or (-t, entry) < (-forms[f][0], forms[f][1])):
                forms[f] = (t, entry)

    def ended(form: str, entry: int, trust: float) -> None:
        for e in rules.endings:
            add(form if form.endswith(e) else form + e, entry, trust)

    stems: dict[str, set[str]] = defaultdict(set)
    family: dict[int, tuple[str, str]] = {}
    for entry, short, spellings, full in entries:
        words = _plain(full or "").split()
        base, stage = (words[-1], words[0] if len(words) == 2 and words[0] in rules.prefixes else "") if words else ("", "")
        family[entry] = (base, stage)
        listed = _spellings(spellings)
        for s in listed:
            add(s, entry, 1.0)
            ended(s, entry, 0.97)
            for p in rules.prefixes.get(stage, ("",)):
                if s.startswith(p) and len(s) - len(p) > 2:
                    stems[base].add(s[len(p) :])
        add(_plain(short or ""), entry, 0.98)
        add(" ".join(words), entry, 0.98)
        add("".join(words), entry, 0.96)
        for name, known in (names or {}).items():
            if known in listed:
                add(name, entry, 0.97)
    # spellings that other members of the family show, with this entry's prefix
    for entry, (base, stage) in family.items():
        for stem in sorted(stems[base]) if base else ():
            root = next((stem.removesuffix(e) for e in rules.endings if stem.endswith(e)), stem)
            for p in rules.prefixes.get(stage, ("",)):
                if stage or family[entry] == (base, ""):
                    add(p + root, entry, 0.95)
                    ended(p + root, entry, 0.95)
    return [(f, e, t) for f, (t, e) in sorted(forms.items())]


def vocabulary(spark: SparkSession, reference: DataFrame, entry: str, short: str, spellings: str, full: str, names: dict[str, str] | None = None) -> DataFrame:
    """(form, entry, trust, n_words, word, word_pos, weight), one row for each word of each form."""
    rows = reference.select(F.col(entry).cast("int").alias("e"), F.col(short).alias("short"), F.col(spellings).alias("spellings"), F.col(full).alias("full"))
    rows = cut(rows.where("e is not null").distinct())
    rules = learn_all(rows)
    words = F.split(F.lower(F.trim(F.coalesce("full", F.lit("")))), " +")
    of_family = (F.size(words) == 1) | ((F.size(words) == 2) & words[0].isin(list(rules.prefixes)))
    # names of no family stand alone, so a frequent last word gathers nothing
    keyed = rows.withColumn("family", F.when(of_family & (F.element_at(words, -1) != ""), F.element_at(words, -1)).otherwise(F.concat(F.lit("\u0001"), F.col("e").cast("string"))))

    def make(b: pd.DataFrame) -> pd.DataFrame:
        text = lambda x: x if isinstance(x, str) else None
        own = sorted(((int(e), text(a), text(s), text(f)) for e, a, s, f in zip(b["e"], b["short"], b["spellings"], b["full"])), key=repr)
        return pd.DataFrame(forms_of(own, rules, names), columns=["form", "entry", "trust"]).astype({"entry": "int32"})

    forms = keyed.groupBy("family").applyInPandas(make, "form string, entry int, trust double")
    best = forms.groupBy("form").agg(F.min(F.struct((-F.col("trust")).alias("t"), "entry")).alias("s"))
    best = cut(best.select("form", "s.entry", (-F.col("s.t")).alias("trust"), F.split("form", r"\s+").alias("w")))
    n_forms = best.count()
    df = best.select(F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    out = best.select("form", "entry", "trust", F.size("w").alias("n_words"), F.posexplode("w").alias("word_pos", "word"))
    return out.join(df, "word").select("form", "entry", "trust", "n_words", "word", "word_pos", F.log(1 + F.lit(n_forms) / F.col("df")).alias("weight"))


def repaired(v: Column) -> Column:
    """Undo UTF-8 read as Latin-1, only where every character could come from that."""
    broken = v.rlike("[\\u00c2\\u00c3][\\u0080-\\u00bf]") & ~v.rlike("[^\\u0000-\\u00ff]")
    return F.when(broken, F.decode(F.encode(F.when(broken, v).otherwise(""), "ISO-8859-1"), "UTF-8")).otherwise(v)


def phrases(values: DataFrame) -> DataFrame:
    """(v) -> (v, phrase_no, reading, token_no, token); reading 0 joins hyphens, 1 splits at them."""
    s = F.lower(F.regexp_replace(repaired(F.col("v")), r"[   \s]+", " "))
    # what stands in brackets or after a free dash qualifies the language before it
    outside = F.trim(F.regexp_replace(F.regexp_replace(s, r"\([^)]*\)|\[[^\]]*\]", " "), r" [-–] .*$", " "))
    has = outside.rlike(r"[\p{L}]")
    s = F.when(has, outside).otherwise(F.regexp_replace(s, r"[()\[\]]", " "))
    s = F.regexp_replace(s, r"[?\"“”„'‘’*:!]+", " ")
    s = F.regexp_replace(s, r"\.-", "/")
    parts = F.split(s, r"[/;,&+|]| u\. | und | and ")
    p = values.select("v", F.posexplode(parts).alias("phrase_no", "phrase"))
    p = p.withColumn("phrase", F.trim(F.regexp_replace("phrase", r"\.", " ")))
    p = p.where("phrase <> ''")
    both = p.withColumn("reading", F.lit(0)).withColumn("text", F.regexp_replace("phrase", "[-–]", "")).unionByName(
        p.where(F.col("phrase").rlike("[-–]")).withColumn("reading", F.lit(1)).withColumn("text", F.regexp_replace("phrase", "[-–]", " "))
    )
    return both.select("v", "phrase_no", "reading", F.posexplode(F.split(F.trim("text"), " +")).alias("token_no", "token")).where("token <> ''")


def deletions(w: Column) -> Column:
    """The word and all words with one letter less; of long words the first and last letters; short words alone."""
    n = F.length(w)
    cut_one = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, n)))
    half = LONG // 2
    ends = F.array(F.concat(F.lit("\u0001"), F.substring(w, 1, half)), F.concat(F.lit("\u0002"), F.right(w, F.lit(half))))
    # words at the bound meet longer and shorter ones
    keys = F.when(n < MIN_REPAIR, F.array(w)).when(n < LONG, F.concat(F.array(w), cut_one)).when(n <= LONG + 1, F.concat(F.array(w), cut_one, ends)).otherwise(F.concat(F.array(w), ends))
    return F.array_distinct(keys)


def repair_tokens(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(token) x (word) within one edit, an exchange of letters counting as one: token, word, sim."""
    left = tokens.select("token", F.explode(deletions(F.col("token"))).alias("key"))
    right = words.select("word", F.explode(deletions(F.col("word"))).alias("key"))
    pairs = left.join(right, "key").select("token", "word").distinct()
    d = F.levenshtein("token", "word")
    moved = (d == 2) & (F.array_sort(F.split("token", "")) == F.array_sort(F.split("word", "")))
    longest = F.greatest(F.length("token"), F.length("word"))
    pairs = pairs.withColumn("sim", F.when(d == 0, 1.0).when((d == 1) | moved, 1 - 1.0 / longest))
    return pairs.where("sim is not null")


def canonicalize(values: DataFrame, vocab: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(v) -> (v, entry, score): every entry a distinct value names; values without one are absent."""
    vocab = broadcast_if_small(vocab)
    toks = phrases(values)
    sims = repair_tokens(toks.select("token").distinct(), vocab.select("word").distinct())
    met = toks.join(sims, "token").join(vocab, "word")
    spot = ["v", "phrase_no", "reading"]
    best_word = met.groupBy(*spot, "form", "entry", "trust", "n_words", "word_pos", "weight").agg(F.max(F.struct("sim", (-F.col("token_no")).alias("t"))).alias("s"))
    scored = best_word.groupBy(*spot, "form", "entry", "trust", "n_words").agg(
        F.count(F.lit(1)).alias("n_met"),
        (F.sum(F.col("weight") * F.col("s.sim")) / F.sum("weight")).alias("soft"),
        F.collect_list(-F.col("s.t")).alias("tokens"),
    )
    scored = scored.where((F.col("n_met") == F.col("n_words")) & (F.size(F.array_distinct("tokens")) == F.col("n_words")) & (F.col("soft") >= threshold))
    scored = scored.withColumn("score", F.col("soft") * F.col("trust"))
    # per token the longest form, then the best ranked; a joined reading that is met wins over a split one
    per_token = scored.select(*spot, "entry", "n_words", "score", F.explode("tokens").alias("token_no"))
    w = Window.partitionBy(*spot, "token_no").orderBy(F.desc("n_words"), F.desc("score"), "entry")
    chosen = per_token.withColumn("r", F.row_number().over(w)).where("r = 1")
    first = F.min("reading").over(Window.partitionBy("v", "phrase_no"))
    chosen = chosen.withColumn("keep", first).where("reading = keep")
    return chosen.groupBy("v", "entry").agg(F.max("score").alias("score"))
