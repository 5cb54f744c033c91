"""Sinks: ordered CSV, routed and size-bounded files, JSON, section files, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma import schema as S

#: Values are written as they are, outer blanks too.
_AS_IS = {k: v for k, v in S.CSV_OPTIONS.items() if k != "multiLine"} | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, order: list[str | Column] | None = None, single_file: bool = False) -> None:
    """CSV with header; with ``order`` rows are range-partitioned, so files in name order are in order."""
    out = df.orderBy(*order) if order else df
    if single_file:
        out = out.coalesce(1) if not order else df.repartition(1).sortWithinPartitions(*order)
    out.write.mode("overwrite").options(**_AS_IS).csv(path)


def write_routed(df: DataFrame, path: str, route: str) -> None:
    df.write.mode("overwrite").options(**_AS_IS).partitionBy(route).csv(path)


def write_bounded(df: DataFrame, path: str, max_bytes: int = 48_000_000, sample: float = 0.05) -> None:
    """Files of at most about ``max_bytes``: the row bound comes from the mean row size."""
    width = F.length(F.to_csv(F.struct(*df.columns)))
    mean = df.sample(fraction=sample, seed=1).agg(F.avg(width)).first()[0] or df.agg(F.avg(width)).first()[0] or 1.0
    df.write.mode("overwrite").options(**_AS_IS, maxRecordsPerFile=max(1, int(max_bytes / (mean + 1)))).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def section_json(tokens: DataFrame) -> DataFrame:
    """(doc, section, content): per book and chapter one JSON object line -> tokens.

    tokens: doc, book, chapter, line_num, doc_token_index, token, pos.  Punctuation has a null id.  Of a
    line number met twice the tokens of its last occurrence stay.
    """
    shown = F.struct(F.col("token"), F.when(F.coalesce(F.col("pos"), F.lit("")) != "punctuation", F.col("doc_token_index")).alias("id"))
    seq = F.col("line_seq") if "line_seq" in tokens.columns else F.lit(0)
    lines = tokens.groupBy("doc", "book", "chapter", "line_num", seq.alias("line_seq")).agg(F.array_sort(F.collect_list(F.struct("doc_token_index", shown.alias("t")))).alias("l"))
    last = lines.groupBy("doc", "book", "chapter", "line_num").agg(F.max_by("l", "line_seq").alias("l"))
    section = F.concat_ws("-", "book", "chapter")
    per = last.groupBy("doc", section.alias("section")).agg(F.array_sort(F.collect_list(F.struct("line_num", F.transform("l", lambda x: x["t"]).alias("t")))).alias("ls"))
    return per.select("doc", "section", F.to_json(F.map_from_entries("ls"), {"ignoreNullFields": "false"}).alias("content"))


def section_index(tokens: DataFrame) -> DataFrame:
    """(doc, book, chapters) in document order; rebuilt, never appended to."""
    firsts = tokens.groupBy("doc", "book", "chapter").agg(F.min("doc_token_index").alias("at"))
    books = firsts.groupBy("doc", "book").agg(F.min("at").alias("at"), F.array_sort(F.collect_list(F.when(F.col("chapter").isNotNull(), F.struct("at", "chapter")))).alias("c"))
    return books.select("doc", "book", F.transform("c", lambda x: x["chapter"]).alias("chapters"), "at").orderBy("doc", "at").drop("at")


def remediation_notices(df: DataFrame, error: str, keys: list[str]) -> DataFrame:
    return df.where(F.col(error).isNotNull()).select(*keys, error)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)
