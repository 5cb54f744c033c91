"""Table schemas and the conventions of the text files."""

from __future__ import annotations

MASTER = (
    "lemma_id int, lang string, lemma string, lemma_normalized string, lemma_translit string, sense_num string, page_num int, row_type string, "
    "orthography string, ipa string, pos string, gender string, stem string, etymology string, etymology_resolved string, entry string, "
    "entry_str string, last_updated timestamp, editor string, components string, gloss string, entry_type string, related int"
)
SENSES = (
    "sense_id int, lang string, lemma_id int, lemma string, sense_num string, page_num int, entry string, entry_str string, "
    "last_updated timestamp, editor string, h_number string, parent_h_number string, gloss string"
)
MATCH = "lex_ref_link_id int, reflex string, gloss_eng string, lemma_id int, lemma string, gloss string, entry_str string"

#: Null is written \N; quotes are doubled inside quoted fields, which may hold line breaks.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\\N"}


def columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]
