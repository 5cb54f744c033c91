"""Deeply nested records to flat tables with Dewey labels.

A column holds JSON: a list of elements, or a lone element standing without its list.  Every node gets the ordinal
path of its place (``2``, ``2.1``, ``2.1/3``), a dot below an element of its own kind and a slash below another;
the parent's label is the path without its last part.  Which tables there are is told by the schema
paths met: the column and the fields on the way down, where fields named as recursive add nothing.  A node's
own scalar fields, and those of single objects in it by dotted names, are its flat content; what is nested
deeper is a node of its own.

Defined results: null, blank and ``null`` columns give nothing; nulls in lists are counted for positions but are no
nodes; a column quoted once more than needed (JSON in a JSON string, or with doubled quotes) is unwrapped; one that
breaks off or is damaged gives one node of type ``broken`` at the column's own path with the reason as content, and
nothing else; lists in lists are nodes of type ``list``; nesting of any depth is read and walked without recursion.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r'\s*(?:([\[\]{}:,])|("(?:[^"\\]|\\.)*")|([^\s\[\]{}:,"]+))', re.S)


def parse_deep(s: str):
    """The JSON value of a text nested too deep for the recursive parser; ValueError if it is none."""
    top: list = []
    stack: list = [top]
    keys: list = [None]
    # what may come next: a value, a key, a colon, or a comma or an end
    want, at, n = "value", 0, len(s)

    def put(v) -> None:
        if isinstance(stack[-1], dict):
            stack[-1][keys[-1]] = v
        else:
            stack[-1].append(v)

    while at < n:
        m = _TOKEN.match(s, at)
        if not m:
            if s[at:].strip():
                raise ValueError(f"no JSON at {at}")
            break
        at = m.end()
        mark, quoted, bare = m.groups()
        if want == "colon":
            if mark != ":":
                raise ValueError(f"no colon before {at}")
            want = "value"
        elif mark in ("]", "}") and mark is not None:
            kind = dict if mark == "}" else list
            empty = want in ("value or end", "key or end")
            if len(stack) == 1 or not isinstance(stack[-1], kind) or not (empty or want == "next"):
                raise ValueError(f"stray end before {at}")
            stack.pop()
            keys.pop()
            want = "next"
        elif want == "next":
            if mark != "," or len(stack) == 1:
                raise ValueError(f"no comma before {at}")
            want = "key" if isinstance(stack[-1], dict) else "value"
        elif want.startswith("key"):
            if quoted is None:
                raise ValueError(f"no key before {at}")
            keys[-1] = json.loads(quoted)
            want = "colon"
        elif mark in ("[", "{"):
            v: list | dict = [] if mark == "[" else {}
            put(v)
            stack.append(v)
            keys.append(None)
            want = "value or end" if mark == "[" else "key or end"
        elif mark is not None:
            raise ValueError(f"no value before {at}")
        else:
            put(json.loads(quoted or bare))
            want = "next"
    if len(stack) != 1 or len(top) != 1:
        raise ValueError("breaks off")
    return top[0]


def _json(s: str):
    try:
        return json.loads(s)
    except RecursionError:
        return parse_deep(s)


def load(text: str | None):
    """The stored value, unwrapped where it is quoted once too often, or None where there is none; ValueError where it is broken."""
    s = (text or "").strip()
    if not s:
        return None
    try:
        value = _json(s)
    except ValueError:
        if len(s) > 1 and s[0] == s[-1] == '"':
            return _json(s[1:-1].replace('""', '"'))
        raise
    if isinstance(value, str):
        inner = value.strip()
        if inner[:1] in ("[", "{"):
            return _json(inner)
        if inner[:1] == '"':
            try:
                return _json(inner)
            except ValueError:
                return value
        if inner == "null":
            return None
    return value


def walk(value, root: str, recursive: frozenset[str] = frozenset(), wanted: frozenset[str] | None = None) -> Iterator[tuple[str, str, str, object]]:
    """(schema path, path, parent path, node) of all nodes of one column, or of those at ``wanted`` schema paths."""
    stack = [(root, "", "", value)]
    while stack:
        schema, prefix, sep, v = stack.pop()
        keep = wanted is None or schema in wanted
        for k, x in enumerate(v if isinstance(v, list) else [v], 1):
            if x is None:
                continue
            path = f"{prefix}{sep}{k}"
            if keep:
                yield schema, path, prefix, x
            if isinstance(x, list):
                stack.append((f"{schema}[]", path, "/", x))
            elif isinstance(x, dict):
                for field, y in x.items():
                    if y is None:
                        continue
                    below = schema if field in recursive else f"{schema}.{field}"
                    if isinstance(y, (dict, list)) or wanted is None or below in wanted:
                        stack.append((below, path, "." if field in recursive else "/", y))


def content(x) -> str | None:
    """Flat content of a node as JSON: a scalar, or the scalar fields of an object."""
    if isinstance(x, list):
        return None
    if not isinstance(x, dict):
        return json.dumps(x, ensure_ascii=False)
    flat = {}
    for k, v in x.items():
        if isinstance(v, dict):
            flat |= {f"{k}.{a}": b for a, b in v.items() if not isinstance(b, (dict, list))}
        elif not isinstance(v, list):
            flat[k] = v
    return json.dumps(flat, ensure_ascii=False)


TYPES = {dict: "object", str: "text", list: "list", bool: "boolean"}
_FIELDS = "schema_path string, record_path string, parent_path string, node_type string, content string"


def flatten(
    df: DataFrame, key: str, columns: list[str], recursive: frozenset[str] = frozenset(), wanted: frozenset[str] | None = None, with_content: bool = True
) -> DataFrame:
    """One row per node: key, schema_path, record_path, parent_path, node_type, content.

    recursive: fields whose elements are of the kind of what holds them.
    wanted: schema paths to give; all that are met if None.  Broken columns are always given.
    """
    names = list(columns)
    src = df.select(F.col(f"`{key}`").alias("k"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    src = src.where(F.greatest(*[F.length(F.trim(F.coalesce(F.col(f"c{i}"), F.lit("")))) for i in range(len(names))], F.lit(0)) > 0)
    kind = df.schema[key].dataType.simpleString()
    held = ["k", *[c.split()[0] for c in _FIELDS.split(", ")]]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ks, out = batch["k"].tolist(), []
            for i, name in enumerate(names):
                for k, text in zip(ks, batch[f"c{i}"]):
                    try:
                        v = load(text)
                    except ValueError as e:
                        out.append((k, name, "", "", "broken", str(e)))
                        continue
                    if v is None:
                        continue
                    for schema, path, parent, x in walk(v, name, recursive, wanted):
                        out.append((k, schema, path, parent, TYPES.get(type(x), "number"), content(x) if with_content else None))
            for at in range(0, len(out), 50_000):
                yield pd.DataFrame(out[at : at + 50_000], columns=held)

    return src.mapInPandas(rows, f"k {kind}, {_FIELDS}").withColumnRenamed("k", key)


def schema_paths(flat: DataFrame) -> DataFrame:
    """(schema_path, node_type, n): which tables the records give, and how large."""
    return flat.groupBy("schema_path", "node_type").agg(F.count(F.lit(1)).alias("n"))


def tables(flat: DataFrame, paths: list[str]) -> dict[str, DataFrame]:
    """One table for each of the schema paths."""
    return {p: flat.where((F.col("schema_path") == p) & (F.col("node_type") != "broken")) for p in paths}
