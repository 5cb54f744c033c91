"""Record matching: keyed joins, cardinality splits, status ladders, scores and reassignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import text


def literal_match(left: DataFrame, right: DataFrame, left_word: str, right_word: str, keys: list[str], how: str = "inner") -> DataFrame:
    """Accent- and case-insensitive equality of two words under equal keys, on precomputed fold keys."""
    a = left.withColumn("__k", text.fold_key(F.col(left_word)))
    b = right.withColumn("__k", text.fold_key(F.col(right_word)))
    return a.join(b, ["__k", *keys], how).drop("__k")


def collated_match(left: DataFrame, right: DataFrame, left_word: str, right_word: str, key: str, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """The same by definition: equality under a collation (always a sort-merge join)."""
    a, b = left.alias("a"), right.alias("b")
    on = (text.collated(F.col(f"a.{left_word}"), collation) == text.collated(F.col(f"b.{right_word}"), collation)) & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    return a.join(b, on).select("a.*", *[f"b.{c}" for c in right.columns if c not in left.columns])


def equal_or_listed(left: DataFrame, right: DataFrame, left_list: str, right_key: str, keys: list[str]) -> DataFrame:
    """left = right OR left LIKE right || ',%': one equi-join on the value and its prefixes before a comma."""
    commas = F.filter(F.sequence(F.lit(1), F.length(left_list)), lambda i: F.substring(F.col(left_list), i, F.lit(1)) == ",")
    prefixes = F.transform(commas, lambda i: F.substring(F.col(left_list), F.lit(1), i - 1))
    named = left.where(F.col(left_list).isNotNull() & (F.length(left_list) > 0)).withColumn(
        "__key", F.explode(F.array_distinct(F.concat(F.array(F.col(left_list)), prefixes)))
    )
    on = [F.col("__key") == F.col(f"__r.{right_key}")] + [F.col(f"__l.{k}") == F.col(f"__r.{k}") for k in keys]
    joined = named.alias("__l").join(right.alias("__r"), on)
    return joined.select("__l.*", *[F.col(f"__r.{c}") for c in right.columns if c not in keys]).drop("__key")


def contains_word(left: DataFrame, right: DataFrame, left_text: str, right_key: str) -> DataFrame:
    """Rows of ``right`` whose key stands as a word in the text: tokens and an equi-join, no LIKE '%x%'."""
    tokens = left.withColumn("__w", F.explode(F.array_distinct(text.all_words(F.lower(F.col(left_text))))))
    return tokens.join(right.withColumn("__w", F.lower(F.col(right_key))), "__w").drop("__w")


def exact_entry(parsed: Column, master: Column) -> Column:
    """Equal once blanks are single and a leading number is off."""
    return F.regexp_replace(parsed, " +", " ") == F.regexp_replace(master, r"^[0-9]+\. +?", "")


def prefix_entry(parsed: Column, master: Column) -> Column:
    p = F.regexp_replace(parsed, " +", " ")
    return (F.length(p) > 1) & master.startswith(p)


_SCRIPT = "\\u0900-\\u097F\\u0980-\\u09FF\\uA8E0-\\uA8FF"


def suffix_entry(parsed: Column, master: Column) -> Column:
    """Equal behind the bracketed headword in native script and its gender."""
    rest = F.regexp_replace(parsed, f"^(?:.*?[{_SCRIPT}]\\)){{1,4}} *(?:[mfn]{{1,3}}\\.)", "")
    rest = F.regexp_replace(rest, " +", " ")
    return (F.length(rest) > 1) & master.endswith(rest)


def similarity(a: Column, b: Column) -> Column:
    """Normalized edit similarity in percent; two empty strings are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def five_way(joined: DataFrame, parsed: str, master: str, exact: Column) -> DataFrame:
    """Add ``status``: exact, single, repeat, multiple, none and ``master_paired``, in one pass.

    joined: one row per candidate, master null where there is none.
    """
    of_parsed = Window.partitionBy(parsed)
    flagged = joined.withColumn("__exact", F.coalesce(exact & F.col(master).isNotNull(), F.lit(False)))
    flagged = flagged.withColumn("__p_exact", F.max("__exact").over(of_parsed)).withColumn("__n", F.count(F.lit(1)).over(of_parsed))
    # masters met exactly come in by a join: a window would gather all rows without a master in one task
    met = flagged.where("__exact").select(F.col(master).alias("__m")).distinct()
    flagged = flagged.join(met, F.col(master) == F.col("__m"), "left").withColumn("master_paired", F.col("__m").isNotNull()).drop("__m")
    status = (
        F.when(F.col(master).isNull(), "none")
        .when(F.col("__exact"), "exact")
        .when(F.col("__p_exact"), "superseded")
        .when(F.col("__n") > 1, "multiple")
        .when(F.col("master_paired"), "repeat")
        .otherwise("single")
    )
    return flagged.withColumn("status", status).drop("__exact", "__p_exact", "__n")


def approved_one_to_one(exact: DataFrame, parsed: str, master: str) -> tuple[DataFrame, DataFrame]:
    """(approved, duplicates): every parsed id that shares a master id with another is set aside."""
    counted = exact.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(master)))
    bad = counted.where("__n > 1").select(parsed).distinct()
    clean = counted.drop("__n")
    return clean.join(bad, parsed, "left_anti"), clean.join(bad, parsed, "left_semi")


def best_candidate(df: DataFrame, group: list[str], score: Column, tie: list[Column]) -> DataFrame:
    """The highest score of each group, the first of equals."""
    w = Window.partitionBy(*group).orderBy(score.desc(), *tie)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def route_by_group(df: DataFrame, group: list[str], score: Column, paired: Column, approve: float = 85, review: float = 60) -> DataFrame:
    """Per group the best score decides: approve (or duplicate), review, unmatched."""
    top = F.max(score).over(Window.partitionBy(*group))
    is_top = score == top
    route = (
        F.when((top > approve) & is_top, F.when(paired, "duplicate").otherwise("approved"))
        .when(top > approve, "dropped")
        .when(top > review, "review")
        .otherwise("unmatched")
    )
    return df.withColumn("route", route)


def apply_decisions(candidates: DataFrame, decisions: DataFrame, group: str, option: str, order: str) -> DataFrame:
    """Recorded verdicts in place of a review loop: the first approved option of a group wins.

    decisions: group, option, verdict.  Adds ``outcome``: approved, dropped, rejected, remaining.
    """
    d = decisions.groupBy(group, option).agg(F.max("verdict").alias("__v"))
    joined = candidates.join(d, [group, option], "left")
    w = Window.partitionBy(group)
    first = F.min(F.when(F.col("__v") == "approve", F.col(order))).over(w)
    joined = joined.withColumn("__first", first)
    outcome = (
        F.when(F.col(order) == F.col("__first"), "approved").when(F.col("__first").isNotNull(), "dropped").when(F.col("__v") == "reject", "rejected").otherwise("remaining")
    )
    return joined.withColumn("outcome", outcome).drop("__v", "__first")


def star_id(c: Column) -> Column:
    """The number of a temporary id like '*12'."""
    return F.replace(c, F.lit("*"), F.lit("")).try_cast("bigint")


def trimmed_lemma(c: Column) -> Column:
    """The lemma before its bracket; empty where there is none."""
    return text.before(c, " (")


def not_in(left: DataFrame, right: DataFrame, column: str, other: str) -> DataFrame:
    """Rows of ``left`` whose value is NOT IN the other column: none at all if that holds a null, never rows with a null value.

    Two steps that shuffle, where the null-aware anti join could only broadcast.
    """
    listed = right.select(F.col(other).alias("__listed"))
    if listed.where("__listed is null").limit(1).count():
        return left.where("false")
    if listed.limit(1).count() == 0:
        return left
    return left.where(F.col(column).isNotNull()).join(listed, F.col(column) == F.col("__listed"), "left_anti")


def missing_pairings(left: DataFrame, right: DataFrame, pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(side, id, has_candidate): ids of either side in no pair, and whether the other side offers any with their key.

    left, right: id and ``key``.
    """
    out = None
    for side, own, own_id, other in (("left", left, left_id, right), ("right", right, right_id, left)):
        alone = own.select(F.col(own_id).alias("id"), "key").distinct().join(pairs.select(F.col(own_id).alias("id")), "id", "left_anti")
        offered = alone.join(other.where("key is not null").select("key").distinct().withColumn("__hit", F.lit(True)), "key", "left")
        one = offered.groupBy("id").agg(F.max(F.coalesce("__hit", F.lit(False))).alias("has_candidate")).select(F.lit(side).alias("side"), "id", "has_candidate")
        out = one if out is None else out.unionByName(one)
    return out


def substitute_ids(df: DataFrame, column: str, mapping: DataFrame, parsed: str, master: str, strict: bool = True) -> DataFrame:
    """Replace an embedded '*digits' by the id it maps to; an unknown one is an error unless not strict."""
    found = df.withColumn("__id", F.regexp_substr(F.col(column), F.lit(r"\*[0-9]+")))
    m = mapping.select(F.col(parsed).alias("__id"), F.col(master).cast("string").alias("__new"))
    out = found.join(m, "__id", "left")
    missing = F.raise_error(F.concat(F.lit("no new id for "), F.col("__id"))).cast("string") if strict else F.col(column)
    value = F.when(F.col("__id").isNull(), F.col(column)).when(F.col("__new").isNull(), missing).otherwise(F.replace(F.col(column), F.col("__id"), F.col("__new")))
    return out.withColumn(column, value).drop("__id", "__new")


def resolve_abbreviation(values: DataFrame, value: str, lookup: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """(value, mapped, status): direct lookup, then agreement of the tokens, then a manual list.

    lookup: token, code.  status: '', empty, unmapped, conflict.  Case, blanks and a closing stop do not tell
    tokens apart; of colliding ones the smallest code counts.
    """
    stopless = lambda c: F.rtrim(c, F.lit("."))
    codes = lookup.where("token is not null").select(text.abbreviation_key(F.col("token")).alias("key"), "code").where("key <> ''")
    codes = codes.groupBy("key").agg(F.min("code").alias("code")).withColumn("bare", stopless(F.col("key")))
    v = values.select(value).distinct().withColumn("raw", F.coalesce(text.abbreviation(F.col(value)), F.lit("")))
    tokens = v.select("raw", F.explode(F.array_union(F.array("raw"), text.abbreviation_tokens(F.col("raw")))).alias("token")).distinct()
    tokens = tokens.withColumn("own", text.abbreviation_key(F.col("token"))).withColumn("own_bare", stopless(F.col("own")))
    # as written, else with a stop, else without
    hit = tokens.join(codes, F.col("own_bare") == F.col("bare"))
    rank = F.when(F.col("key") == F.col("own"), 0).when(F.col("key") == F.concat("bare", F.lit(".")), 1).when(F.col("key") == F.col("bare"), 2)
    hit = hit.withColumn("rank", rank).where("rank is not null").groupBy("raw", "token").agg(F.min(F.struct("rank", "code"))["code"].alias("code"))
    direct = v.join(hit.where("token = raw").select("raw", F.col("code").alias("direct")), "raw", "left")
    parts = v.select("raw", F.explode(text.abbreviation_tokens(F.col("raw"))).alias("token")).distinct().join(hit, ["raw", "token"])
    agreed = parts.groupBy("raw").agg(F.collect_set("code").alias("codes"))
    joined = direct.join(agreed, "raw", "left")
    n = F.coalesce(F.size("codes"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    status = F.when(F.col("raw") == "", "empty").when(F.col("direct").isNotNull() | (n == 1), "").when(n == 0, "unmapped").otherwise("conflict")
    mapped = F.when(F.col("raw") == "", None).otherwise(F.coalesce("direct", F.when(n == 1, F.col("codes")[0])))
    out = joined.select(value, mapped.alias("mapped"), status.alias("status"))
    if manual is None:
        return out
    by_hand = manual.groupBy("raw").agg(F.max("codes").alias("by_hand")).withColumnRenamed("raw", "__m")
    key = F.regexp_replace(F.trim(F.col(value)), r"\s+", " ")
    out = out.join(F.broadcast(by_hand), key == F.col("__m"), "left").drop("__m")
    return out.withColumn("mapped", F.coalesce("mapped", "by_hand")).withColumn("status", F.when(F.col("by_hand").isNotNull(), "").otherwise(F.col("status"))).drop("by_hand")
