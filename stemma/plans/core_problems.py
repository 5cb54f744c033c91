"""Queries of the general data problems: hierarchies, packed fields, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.operators import hierarchy, nested, packed
from stemma.session import cut, table

# ---------------------------------------------------------------- hierarchies


def _senses(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "lex_senses").select("sense_id", "lang", "lemma_id", "h_number", "parent_h_number", "last_updated")
    rows = cut(hierarchy.latest_versions(rows, "sense_id", "last_updated"))
    return rows, cut(hierarchy.nodes_of(rows, "lang", "h_number", "parent_h_number", "sense_id"))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.coalesce(F.col("lang"), F.lit("")).alias("r_scope"),
        hierarchy.name_key(F.col("h_number")).alias("r_key"),
        "lang", "lemma_id", "h_number", "sense_id",
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    rows, nodes = _senses(spark, sf)
    on_loop = hierarchy.loop_nodes(nodes).join(nodes, "node").select("scope_", "key_")
    named = _named(rows)
    return named.join(
        on_loop, (F.col("r_scope") == F.col("scope_")) & (F.col("r_key") == F.col("key_")), "left_semi"
    ).select("lang", "lemma_id", "h_number").distinct()


def p1_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Every sense with its path of sense ids, depth, root, number of senses below, and state."""
    rows, nodes = _senses(spark, sf)
    return (
        hierarchy.hierarchy(nodes)
        .join(nodes.select("node", "scope_", "key_", "parent_status"), "node")
        .select(
            F.col("scope_").alias("lang"), F.col("key_").alias("h_key"), F.col("node").alias("sense_id"), "root", "depth",
            F.concat_ws("/", "path").alias("path"), "n_below", "state", "parent_status",
        )
    )


def p1_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of a sense and a sense below it, with the distance between them."""
    _, nodes = _senses(spark, sf)
    return hierarchy.descendants(nodes)


# ---------------------------------------------------------------- packed fields


def _packed(spark: SparkSession, sf: str, at_least: int) -> DataFrame:
    master = table(spark, sf, "lex_master").select("lang", F.col("lemma_id").alias("row_id"), "gloss", "conceptsets")
    links = table(spark, sf, "lex_ref_link").select(F.lit("").alias("lang"), F.col("lex_ref_link_id").alias("row_id"), "gloss_eng")
    parts = []
    for df, field, column in (
        (links, "lex_ref_link.gloss_eng", "gloss_eng"),
        (master, "lex_master.gloss", "gloss"),
        (master, "lex_master.conceptsets", "conceptsets"),
    ):
        parts.append(df.select(F.lit(field).alias("field_name"), "lang", "row_id", F.col(column).alias("v")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return packed.split_packed(rows, "v", ["field_name", "lang", "row_id"], at_least)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    # entries delivered twice give their items once
    return _packed(spark, sf, 2).select("field_name", "lang", "row_id", "item_pos", "item").distinct()


def p3_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every item of every field, single ones too, with the error flag of its field."""
    return _packed(spark, sf, 1).distinct()


def p3_flags(spark: SparkSession, sf: str) -> DataFrame:
    """How many fields of each kind and number of items parsed with which flag."""
    items = _packed(spark, sf, 1)
    fields = items.groupBy("field_name", "lang", "row_id", "parse_flag").agg(F.max("item_pos").alias("n_items"))
    return fields.groupBy("field_name", "parse_flag", "n_items").agg(F.count(F.lit(1)).alias("n_fields"))


# ---------------------------------------------------------------- nested records


# fixed values: the tables asked for, by schema path
_KINDS = {
    "senses_json": "sense", "senses_json.cit": "sense_cit", "citations_json": "citation",
    "translations_json": "translation", "translations_json.alt": "translation_alt",
}
_NESTED = ["senses_json", "citations_json", "translations_json"]


def _records(spark: SparkSession, sf: str, with_content: bool) -> DataFrame:
    flat = nested.flatten(table(spark, sf, "lsj_part18_flat_01"), "global_index", _NESTED, frozenset(["sub"]), frozenset(_KINDS), with_content)
    kind = F.create_map(*[F.lit(x) for k in _KINDS.items() for x in k])[F.col("schema_path")]
    return flat.where("node_type in ('object', 'text')").withColumn("record_kind", kind)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf, False).select("global_index", "record_kind", "record_path", "parent_path").distinct()


def p6_records(spark: SparkSession, sf: str) -> DataFrame:
    """All records with their content, flat fields taken out of the record."""
    flat = _records(spark, sf, True).distinct()
    fields = F.from_json("content", "map<string,string>")
    is_text = F.col("node_type") == "text"
    return flat.select(
        "global_index", "record_kind", "record_path", "parent_path",
        F.when(is_text, F.from_json(F.concat(F.lit('{"t":'), "content", F.lit("}")), "t string")["t"])
        .otherwise(F.coalesce(fields["def"], fields["text"], fields["quote"]))
        .alias("record_text"),
        F.when(~is_text, fields["n"]).alias("sense_number"),
        F.when(~is_text, F.coalesce(fields["biblio.author"], fields["biblio"])).alias("source"),
    )


def p6_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every schema path that the nested columns hold, whatever its fields are called, with its nodes; broken columns too."""
    flat = nested.flatten(table(spark, sf, "lsj_part18_flat_01"), "global_index", [*_NESTED, "etymologies_json", "biblio_json", "gramgrp_json", "xrefs_json"], frozenset(["sub"]), None, False)
    return nested.schema_paths(flat)


QUERIES = {
    "p1_found": p1_found,
    "p1_hierarchy": p1_hierarchy,
    "p1_descendants": p1_descendants,
    "p3_found": p3_found,
    "p3_items": p3_items,
    "p3_flags": p3_flags,
    "p6_found": p6_found,
    "p6_records": p6_records,
    "p6_tables": p6_tables,
}

_NODES = r"""
WITH RECURSIVE latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sense_id ORDER BY last_updated DESC NULLS LAST, parent_h_number DESC NULLS LAST) AS rn FROM lex_senses) WHERE rn = 1),
node AS (
  SELECT coalesce(lang, '') AS sc, lower(trim(h_number, E' \t\r\n' || chr(160))) AS k, min(sense_id) AS id
  FROM latest WHERE trim(h_number, E' \t\r\n' || chr(160)) <> '' GROUP BY ALL),
edge AS (
  SELECT n.id, p.id AS parent FROM node n JOIN latest l ON l.sense_id = n.id
  JOIN node p ON p.sc = n.sc AND p.k = lower(trim(l.parent_h_number, E' \t\r\n' || chr(160)))),
tree(id, root, depth, path) AS (
  SELECT n.id, n.id, 0, [n.id] FROM node n WHERE n.id NOT IN (SELECT id FROM edge)
  UNION ALL SELECT e.id, t.root, t.depth + 1, list_append(t.path, e.id) FROM tree t JOIN edge e ON e.parent = t.id),
above AS (SELECT id AS descendant, unnest(path) AS node, unnest(range(len(path), 0, -1)) - 1 AS distance FROM tree)
"""

ORACLE: dict[str, str] = {
    "p1_hierarchy": _NODES + r"""
, walk(start, cur) AS (SELECT id, parent FROM edge WHERE id NOT IN (SELECT id FROM tree) UNION SELECT w.start, e.parent FROM walk w JOIN edge e ON e.id = w.cur),
onloop AS (SELECT DISTINCT start AS id FROM walk WHERE start = cur),
below AS (SELECT node AS id, count(*) AS n FROM above WHERE distance > 0 GROUP BY 1)
SELECT n.sc AS lang, n.k AS h_key, n.id AS sense_id, t.root, t.depth, array_to_string(coalesce(t.path, []), '/') AS path,
  CASE WHEN t.id IS NOT NULL THEN coalesce(b.n, 0) END AS n_below,
  CASE WHEN t.id IS NOT NULL THEN 'tree' WHEN o.id IS NOT NULL THEN 'loop' ELSE 'below_loop' END AS state,
  CASE WHEN coalesce(trim(l.parent_h_number, E' \t\r\n' || chr(160)), '') = '' THEN 'none' WHEN e.id IS NULL THEN 'missing' ELSE 'found' END AS parent_status
FROM node n JOIN latest l ON l.sense_id = n.id LEFT JOIN edge e ON e.id = n.id LEFT JOIN tree t ON t.id = n.id LEFT JOIN onloop o ON o.id = n.id LEFT JOIN below b ON b.id = n.id""",
    "p1_descendants": _NODES + """
SELECT node, descendant, distance FROM above WHERE distance > 0""",
    "p1_found": r"""
WITH RECURSIVE latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sense_id ORDER BY last_updated DESC NULLS LAST, parent_h_number DESC NULLS LAST) AS rn FROM lex_senses) WHERE rn = 1),
node AS (
  SELECT coalesce(lang, '') AS sc, lower(trim(h_number, E' \t\r\n' || chr(160))) AS k, min(sense_id) AS id
  FROM latest WHERE trim(h_number, E' \t\r\n' || chr(160)) <> '' GROUP BY ALL),
edge AS (
  SELECT n.id, p.id AS parent FROM node n JOIN latest l ON l.sense_id = n.id
  JOIN node p ON p.sc = n.sc AND p.k = lower(trim(l.parent_h_number, E' \t\r\n' || chr(160)))),
walk(start, cur) AS (
  SELECT id, parent FROM edge UNION SELECT w.start, e.parent FROM walk w JOIN edge e ON e.id = w.cur)
SELECT DISTINCT l.lang, l.lemma_id, l.h_number
FROM walk w JOIN node n ON n.id = w.start
JOIN latest l ON coalesce(l.lang, '') = n.sc AND lower(trim(l.h_number, E' \t\r\n' || chr(160))) = n.k
WHERE w.start = w.cur""",
}
