"""Mixed-content markup: one parse per record inside Arrow batches, rules as data."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F

_NAMED = re.compile(r"&(?!(?:amp|lt|gt|quot|apos);)([A-Za-z][\w.-]*);")


def parse(record: str, wrapper: str = "record") -> ET.Element:
    """The record as a tree; unknown entities become text, a broken record is wrapped as plain text."""
    safe = _NAMED.sub(lambda m: html.unescape(m[0]).replace("&", "&amp;"), record)
    safe = re.sub(r"&(?!#|\w+;)", "&amp;", safe)
    try:
        return ET.fromstring(safe)
    except ET.ParseError:
        try:
            return ET.fromstring(f"<{wrapper}>{safe}</{wrapper}>")
        except ET.ParseError:
            e = ET.Element(wrapper)
            e.text = record
            return e


def inner_text(e: ET.Element) -> str:
    return "".join(e.itertext())


def first(e: ET.Element, *tags: str) -> ET.Element | None:
    return next((x for x in e.iter() if x.tag in tags and x is not e), None)


def comes_before(root: ET.Element, a: str, b: str) -> bool:
    """Whether the first a stands before the first b in document order; a missing b is after all."""
    for x in root.iter():
        if x.tag == a:
            return True
        if x.tag == b:
            return False
    return False


def leading_run(root: ET.Element, tags: set[str], through: set[str]) -> list[str]:
    """Texts of the wanted children up to the first child that is neither wanted nor passed through."""
    out = []
    for x in root:
        if x.tag in tags:
            out.append(inner_text(x).strip())
        elif x.tag not in through:
            break
    return out


def gloss_of(root: ET.Element, tag: str = "tr") -> str:
    """The first translation and those that follow it with nothing but separators between."""
    for parent in root.iter():
        kids = list(parent)
        for i, x in enumerate(kids):
            if x.tag != tag:
                continue
            parts, tail = [inner_text(x)], x.tail or ""
            for y in kids[i + 1 :]:
                if y.tag != tag or tail.strip(" ,;") != "":
                    break
                parts.append(tail + inner_text(y))
                tail = y.tail or ""
            return "".join(parts).strip()
    return ""


def first_or_child_text(root: ET.Element, tag: str = "trn") -> str:
    x = first(root, tag)
    if x is not None:
        return (x.text or "").strip()
    return inner_text(root[0]).strip() if len(root) else inner_text(root).strip()


def remove_keeping_tail(root: ET.Element, target: ET.Element) -> None:
    """Take an element out; its tail joins the text before it."""
    for parent in root.iter():
        kids = list(parent)
        if target in kids:
            i = kids.index(target)
            if target.tail:
                if i:
                    kids[i - 1].tail = (kids[i - 1].tail or "") + target.tail
                else:
                    parent.text = (parent.text or "") + target.tail
            parent.remove(target)
            return


@dataclass(frozen=True)
class Rules:
    """How tags are written: left out with content, unwrapped, kept, renamed, indented, or as a span."""

    drop: frozenset[str] = frozenset()
    unwrap: frozenset[str] = frozenset()
    keep: frozenset[str] = frozenset({"i", "b"})
    rename: dict[str, str] = field(default_factory=dict)
    indent: frozenset[str] = frozenset()
    language: str = ""
    step: int = 50


# fixed values: tags by dictionary
RULES = {
    "latin": Rules(unwrap=frozenset({"sense", "entryFree"}), language="latin"),
    "greek": Rules(unwrap=frozenset({"sense", "entryFree"}), drop=frozenset({"pb", "cb"}), language="greek"),
    "oldnorse": Rules(unwrap=frozenset({"sense", "com", "trn", "entry"}), indent=frozenset({"m1", "m2", "m3", "m4", "m5"}), language="oldnorse"),
    "sanskrit": Rules(unwrap=frozenset({"body", "s"}), drop=frozenset({"tail", "h"}), language="sanskrit"),
}


def write_html(e: ET.Element, rules: Rules, base_indent: int = 1) -> str:
    """The tree as HTML by the rules, nested as deep as it is, without recursion limits of its own."""
    out: list[str] = []
    stack: list[tuple[str, object]] = [("open", e)]
    while stack:
        kind, x = stack.pop()
        if kind == "text":
            out.append(x)
            continue
        tag = rules.rename.get(x.tag, x.tag)
        dropped = x.tag in rules.drop
        before = after = ""
        if not dropped and x.tag not in rules.unwrap:
            if x.tag in rules.keep:
                before, after = f"<{tag}>", f"</{tag}>"
            elif x.tag in rules.indent:
                depth = int(x.tag[-1]) - base_indent
                style = f' style="margin-left={depth * rules.step}px"' if depth > 0 else ""
                before, after = f'<div class="{rules.language} bodytext"{style}>', "</div>"
            else:
                before, after = f'<span class="{html.escape(tag)}">', "</span>"
        out.append(before)
        todo: list[tuple[str, object]] = []
        if not dropped:
            todo.append(("text", html.escape(x.text or "", quote=False)))
            for y in x:
                todo += [("open", y), ("text", html.escape(y.tail or "", quote=False))]
        stack += [("text", after), *reversed(todo)]
    return "".join(out)


def _romans(n: int) -> list[str]:
    """The first ``n`` roman numbers, below 40."""
    ones = ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")
    return ["X" * (i // 10) + ones[i % 10] for i in range(1, n + 1)]


@dataclass(frozen=True)
class Label:
    """One kind of label: its values in order, the mark that closes it, the word that has to follow."""

    values: tuple[str, ...]
    close: str
    follows: str = ""


# fixed values: how far the numbering of definitions and senses goes
DEFINITION_LABELS = (Label(tuple(_romans(39)), ")"),)
SENSE_LABELS = (
    Label(tuple(_romans(5)), "."),
    Label(tuple(str(i) for i in range(20)), ")"),
    Label(("A", "B"), ".", "with"),
)


def read_label(text: str, grammar: tuple[Label, ...]) -> tuple[str, str] | None:
    """(label, rest) of a text that opens with a label and a blank or with nothing but a label."""
    head, _, rest = text.partition(" ")
    for kind in grammar:
        value = head.removesuffix(kind.close)
        if value != head and value in kind.values and (not kind.follows or rest.startswith(kind.follows + " ")):
            return value, rest.lstrip()
    return None


def split_definitions(entry: ET.Element) -> list[list[ET.Element]]:
    """Children of an entry per definition, which a bold roman number with a bracket opens."""
    starts = []
    for i, x in enumerate(entry):
        b = x.find("b") if x.tag == "m1" else None
        if b is not None and read_label(inner_text(b).strip(), DEFINITION_LABELS):
            starts.append(i)
    kids = list(entry)
    if len(starts) < 2:
        return [kids]
    return [kids[a:b] for a, b in zip(starts, [*starts[1:], len(kids)])]


def split_senses(kids: list[ET.Element]) -> list[tuple[str, int, list[ET.Element]]]:
    """(label, level, children) in order; the part before the first delimiter has an empty label."""
    out: list[tuple[str, int, list[ET.Element]]] = []
    for x in kids:
        opened = read_label(x.text or "", SENSE_LABELS) if x.tag in RULES["oldnorse"].indent and " " in (x.text or "") else None
        if opened:
            label, x.text = opened
            out.append((label, int(x.tag[1]), [x]))
        elif out:
            out[-1][2].append(x)
        else:
            out.append(("", 0, [x]))
    return out


def split_numbered_divisions(body: str) -> list[tuple[str | None, str]]:
    """(number, text) of the parts that empty division marks cut a body into."""
    parts = re.split(r'<div\s+n="([^"]*)"\s*/>', body)
    return [(None, parts[0]), *zip(parts[1::2], parts[2::2])]


def root_kind(tag: str) -> tuple[str, int]:
    """(kind, level) of a record by its root tag: headword, continuation, variant or extension."""
    m = re.fullmatch(r"H([1-4])([A-E]?)", tag)
    if not m:
        return "other", 0
    kind = {"": "headword", "A": "variant", "B": "continuation", "C": "continuation", "E": "extension"}.get(m[2], "other")
    return kind, int(m[1])


_GENDER = {"ὁ": "m.", "ἡ": "f.", "τό": "n.", "m": "m.", "f": "f.", "n": "n."}
_POS = {"a.": "adj.", "m.": "n.", "f.": "n.", "n.": "n.", "v.": "v.", "v. refl.": "v.", "adj.": "adj.", "adv.": "adv.", "pp.": "pp.", "prep.": "prep.", "interj.": "interj."}


def pos_and_gender(marks: list[str]) -> tuple[str | None, str | None]:
    """Part of speech and gender of the first mark that tells, articles as genders."""
    for m in marks:
        m = m.strip()
        if m in _GENDER:
            return "n.", _GENDER[m]
        if m in _POS:
            return _POS[m], m if m in ("m.", "f.", "n.") else None
    return None, None


def textify(e: ET.Element, blocks: frozenset[str] = frozenset({"sense", "div", "p"})) -> str:
    """Running text with one blank where tags or blocks meet words, none before closing marks."""
    text = " ".join(_spaced(e, blocks).split())
    return re.sub(r"\s+([,.;:!?)\]])", r"\1", re.sub(r"([(\[])\s+", r"\1", text))


def _spaced(e: ET.Element, blocks: frozenset[str]) -> str:
    out: list[str] = []
    stack: list[tuple[ET.Element | None, str]] = [(e, "")]
    while stack:
        x, text = stack.pop()
        if x is None:
            out.append(text)
            continue
        edge = " " if x.tag in blocks else ""
        out.append(edge + (x.text or ""))
        stack.append((None, edge))
        for y in reversed(x):
            stack += [(None, y.tail or ""), (y, "")]
    return "".join(out)


def flat_record(record: str) -> dict:
    """Lists and flags of one dictionary record: senses, translations, citations, references."""
    root = parse(record)
    texts = lambda t: [inner_text(x).strip() for x in root.iter(t)]
    cits = [{"biblio": inner_text(x.find("bibl")).strip() if x.find("bibl") is not None else None, "quote": inner_text(x.find("quote")).strip() if x.find("quote") is not None else None} for x in root.iter("cit")]
    grammar = [{"pos": (g.findtext("pos") or "").strip() or None, "gender": (g.findtext("gen") or "").strip() or None, "itype": (g.findtext("itype") or "").strip() or None} for g in root.iter("gramGrp")]
    refs = [{"target": x.get("target"), "text": inner_text(x).strip()} for t in ("ref", "xr") for x in root.iter(t)]
    return {
        "entry_id": root.get("id"), "headword": root.get("key") or (texts("orth") or [None])[0],
        "orthography": texts("orth"), "pos": (texts("pos") or [None])[0], "gender": (texts("gen") or [None])[0],
        "senses": [{"n": x.get("n"), "level": x.get("level"), "text": textify(x)} for x in root.iter("sense")],
        "translations": texts("tr"), "etymologies": texts("etym"), "citations": cits, "pages": [x.get("n") for x in root.iter("pb")],
        "biblio": texts("bibl"), "gramgrp": grammar, "xrefs": refs,
    }


FLAT = (
    "entry_id string, headword string, orthography array<string>, pos string, gender string, "
    "senses array<struct<n:string,level:string,text:string>>, translations array<string>, etymologies array<string>, "
    "citations array<struct<biblio:string,quote:string>>, pages array<string>, biblio array<string>, "
    "gramgrp array<struct<pos:string,gender:string,itype:string>>, xrefs array<struct<target:string,text:string>>"
)


def flatten_records(df, column: str, keys: list[str]):
    """keys, the fields of FLAT, and counts and flags of every record."""
    names = [c.split()[0] for c in re.split(r", (?=\w+ (?:string|array))", FLAT)]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            flat = [flat_record(r) for r in b[column]]
            out = b[keys].copy()
            for n in names:
                out[n] = [f[n] for f in flat]
            yield out

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    out = df.where(F.col(column).isNotNull()).select(*keys, column).mapInPandas(rows, f"{kinds}, {FLAT}")
    lists = {"sense": "senses", "tr": "translations", "etym": "etymologies", "cit": "citations", "xref": "xrefs"}
    counts = {f"{k}_count": F.size(v) for k, v in lists.items()} | {f"has_{k}": F.size(v) > 0 for k, v in lists.items()}
    as_json = {f"{k}_json": F.to_json(k) for k in ("senses", "translations", "etymologies", "citations", "biblio", "gramgrp", "xrefs")}
    # the first page break inside the record; where it begins is carried from the records before it
    return out.withColumns(counts | as_json | {"page_inside": F.try_element_at("pages", F.lit(-1))})


def with_pages(flat, partition: list[str], order: str):
    """Add page_start and page_end to flat records: the last page broken to before the record, and in it."""
    from stemma.operators import windows

    out = windows.fill_forward(flat, "page_inside", partition, order, "page_start", inclusive=False)
    return out.withColumn("page_end", F.coalesce("page_inside", "page_start"))


def to_html(rules_name: str, base_indent: int = 1):
    rules = RULES[rules_name]

    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda r: write_html(parse(r), rules, base_indent), na_action="ignore")

    return run
