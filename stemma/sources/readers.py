"""Sources: CSV, TSV, JSONL, record-wise XML, line-oriented markup, annotated text, HTML, SQL dumps."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma import schema as S
from stemma.functions import text
from stemma.operators import windows

# ------------------------------------------------------------------ delimited files


def read_csv(spark: SparkSession, paths: str | list[str], names: list[str], header: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Columns named by position, all strings, empty and \\N read as null; ``keep`` drops the others.

    Files have one layout; a header is skipped, not trusted.  Order of columns in the file counts.
    """
    raw = spark.read.options(**{**S.CSV_OPTIONS, "header": str(header).lower()}).schema(", ".join(f"`{n}` string" for n in names)).option("enforceSchema", "true")
    df = raw.csv(paths)
    df = df.select(*[F.when(F.col(n).isin("", "\\N"), None).otherwise(F.col(n)).alias(n) for n in names])
    return df.select(*keep) if keep else df


def typed(df: DataFrame, types: dict[str, str], dates: dict[str, str] | None = None) -> DataFrame:
    """Cast strings after trimming; what does not parse becomes null, also hours past a 12-hour pattern."""
    for name, kind in types.items():
        df = df.withColumn(name, F.nullif(F.trim(F.col(name)), F.lit("")).try_cast(kind))
    for name, pattern in (dates or {}).items():
        df = df.withColumn(name, F.try_to_timestamp(F.col(name), F.lit(pattern)))
    return df


def append_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_constant_from(df: DataFrame, lookup: DataFrame, condition: str, column: str, out: str) -> DataFrame:
    """Add one looked-up value to every row; anything but one hit is an error."""
    hits = lookup.where(condition).select(column).limit(2).collect()
    if len(hits) != 1:
        raise ValueError(f"{condition} names {'no' if not hits else 'more than one'} row")
    return df.withColumn(out, F.lit(hits[0][0]))


def read_ragged_tsv(spark: SparkSession, path: str, n_columns: int = 3) -> DataFrame:
    """raw, count, mapped ...: tabs may be missing or too many; outer blanks and empty parts are off."""
    parts = F.filter(F.transform(F.split("value", "\t"), lambda x: F.trim(x)), lambda x: x != "")
    lines = spark.read.text(path).select(parts.alias("p")).where(F.size("p") > 0)
    return lines.select(*[F.get("p", F.lit(i)).alias(f"c{i}") for i in range(n_columns)])


def read_jsonl(spark: SparkSession, path: str, json_schema: str, lang: str | None = None, lang_code: str | None = None) -> DataFrame:
    """Records of one language; records without language are skipped, no record at all is an error."""
    df = spark.read.schema(json_schema).json(path)
    if lang is not None:
        hit = F.col("lang") == lang
        if lang_code is not None:
            hit = hit | (F.col("lang_code") == lang_code)
        df = df.where(F.col("lang").isNotNull() & hit)
        if df.limit(1).count() == 0:
            raise ValueError(f"no record of language {lang}")
    return df


def next_id(df: DataFrame, column: str) -> int:
    return (df.agg(F.max(column)).first()[0] or 0) + 1


def column_catalog(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, n, t) for i, (n, t) in enumerate(df.dtypes, 1)], "ordinal int, name string, type string")


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


# ------------------------------------------------------------------ XML


def read_xml_records(spark: SparkSession, path: str, tag: str, entities: dict[str, str] | None = None) -> DataFrame:
    """(file, seq, record): one row per element, as text with its mixed content intact.

    Files are cut at the end tag by the reader, so a file of any size is read in parallel; records do
    not nest.  Named entities are replaced before any parser sees them.
    """
    lines = spark.read.option("lineSep", f"</{tag}>").text(path)
    start = rf"(?s)<{tag}(?=[\s>/]).*"
    one = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
        F.regexp_extract("value", start, 0).alias("body"),
    ).where("body <> ''")
    record = F.concat("body", F.lit(f"</{tag}>"))
    for name, value in (entities or {}).items():
        record = F.replace(record, F.lit(f"&{name};"), F.lit(value))
    # a file may be many blocks: place is block and then order within it
    placed = one.select("file", F.struct("block", "place").alias("place"), record.alias("record"))
    return windows.row_number_in(placed, ["file"], "place", "seq").select("file", "seq", "record")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, line) in file order."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("place"), F.col("value").alias("line"))
    return windows.row_number_in(raw, ["file"], "place", "seq").select("file", "seq", "line")


def classify_dictionary_lines(lines: DataFrame) -> DataFrame:
    """Lines of page-oriented markup: kind (page, header, letter, entry, overflow, blank), page, entry_no.

    Entry lines open with a bold headword; other text continues the entry before.
    """
    s = F.trim("line")
    kind = (
        F.when(s == "", "blank").when(s.rlike(r"(?i)^<page num="), "page").when(s.rlike(r"(?i)^<header>"), "header")
        .when(s.rlike(r"(?i)^<letterheader>"), "letter").when(s.rlike(r"(?i)^<b>"), "entry").otherwise("overflow")
    )
    number = F.nullif(F.regexp_extract("line", r"(?i)<page num=\"?(\d+)", 1), F.lit("")).cast("int")
    out = lines.withColumn("kind", kind).withColumn("number", number).withColumn("opens", (F.col("kind") == "entry").cast("int"))
    out = windows.fill_forward(out, "number", ["file"], "seq", "page")
    return windows.running_sum(out, "opens", ["file"], "seq", "entry_no").drop("number", "opens")


def join_overflow(classified: DataFrame) -> DataFrame:
    """(file, entry_no, page, entry): overflow lines appended to the entry they continue, in order."""
    text_lines = classified.where("kind in ('entry', 'overflow') and entry_no > 0")
    grouped = text_lines.groupBy("file", "entry_no").agg(F.min("page").alias("page"), F.array_sort(F.collect_list(F.struct("seq", F.trim("line").alias("line")))).alias("l"))
    return grouped.select("file", "entry_no", "page", F.array_join(F.transform("l", lambda x: x["line"]), " ").alias("entry"))


# ------------------------------------------------------------------ annotated text, HTML, SQL


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, book, chapter, line, text); lines without a mark have ``error`` set."""
    lines = read_lines(spark, path).where(F.trim("line") != "")
    book, chapter, number = text.location(F.col("line"))
    return lines.select("file", "seq", book.alias("book"), chapter.alias("chapter"), number.alias("line_num"), text.line_mark(F.col("line")).alias("text"), F.when(number.isNull(), "no location mark").alias("error"))


def html_text(df: DataFrame, column: str, tag: str, attribute: str | None = None, value: str | None = None) -> DataFrame:
    """Texts of the elements with this tag (and attribute) of a fetched page, in page order."""
    from html.parser import HTMLParser

    def find(page: str | None) -> list[str]:
        found: list[str] = []

        class Reader(HTMLParser):
            depth, parts = 0, []

            def handle_starttag(self, name, attrs):
                if self.depth:
                    self.depth += name == tag
                elif name == tag and (attribute is None or dict(attrs).get(attribute) == value):
                    self.depth, self.parts = 1, []

            def handle_endtag(self, name):
                if self.depth and name == tag:
                    self.depth -= 1
                    if not self.depth:
                        found.append(" ".join("".join(self.parts).split()))

            def handle_data(self, data):
                if self.depth:
                    self.parts.append(data)

        Reader(convert_charrefs=True).feed(page or "")
        return found

    @F.pandas_udf("array<string>")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(find)

    return df.withColumn("texts", texts(F.col(column)))


_TOKEN = re.compile(r"'((?:[^'\\]|\\.|'')*)'|([^\s,()']+)|([(),])", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "\\": "\\", "'": "'", '"': '"', "Z": "\x1a"}


def dump_rows(statement: str) -> list[list[str | None]]:
    """Value tuples of an INSERT statement; NULL is null, numbers stay text."""
    at = statement.upper().find("VALUES")
    rows, row = [], None
    for m in _TOKEN.finditer(statement, at + 6 if at >= 0 else 0):
        quoted, bare, mark = m.groups()
        if mark == "(":
            row = []
        elif mark == ")" and row is not None:
            rows.append(row)
            row = None
        elif row is not None and quoted is not None:
            row.append(re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), quoted.replace("''", "'"), flags=re.S))
        elif row is not None and bare is not None:
            row.append(None if bare.upper() == "NULL" else bare)
        elif bare is not None and bare.startswith(";"):
            break
    return rows


def read_sql_dump(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of all INSERT statements of a dump, columns named by position, all strings.

    The file is cut where a line opens with INSERT INTO, so a semicolon, with or without a line end behind it,
    may stand inside quoted text; a statement ends at the first semicolon outside.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r[: len(names)] + [None] * (len(names) - len(r)) for s in batch["value"] for r in dump_rows(s)]
            yield pd.DataFrame(rows, columns=names, dtype="object")

    pieces = spark.read.option("lineSep", "\nINSERT INTO ").text(path)
    statements = pieces.where(F.col("value").rlike(r"(?is)^\s*(?:insert\s+into\s+)?\S+\s*(?:\([^)]*\)\s*)?values"))
    return statements.mapInPandas(parse, ", ".join(f"`{n}` string" for n in names))


def unescaped(s: str) -> str:
    return html.unescape(s)
