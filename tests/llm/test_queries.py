"""Every query of the text problems on the smallest tables."""

import os

import pytest

from stemma.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
FOUND = {
    "p2_found": ["field_name", "lex_ref_link_id", "lemma_id"], "p4_found": ["field_name", "source_key", "row_id"],
    "p5_found": ["lang", "lemma_id", "lex_ref_link_id"], "p7_found": ["source_table", "row_key", "abbrev_id"], "p10_found": ["doc_id"],
}


@pytest.fixture(scope="module")
def rows(spark):
    kept = {}

    def get(name):
        if name not in kept:
            df = Q.QUERIES[name](spark, DATA)
            kept[name] = (df.columns, df.collect())
        return kept[name]

    return get


@pytest.mark.parametrize("name", sorted(FOUND))
def test_found(rows, name):
    columns, got = rows(name)
    assert columns == FOUND[name] and got and len(got) == len(set(got))


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(FOUND)))
def test_others(rows, name):
    columns, got = rows(name)
    assert got and len(columns) == len(set(columns))


def test_found_agrees_with_the_longer_queries(rows):
    standard = rows("p2_standard")[1]
    assert {(r.field_name, r.lex_ref_link_id, r.lemma_id) for r in standard if r.value != r.standard} == set(map(tuple, rows("p2_found")[1]))
    kinds = {r.doc_id for r in rows("p10_statistics")[1] if r.kind in ("list", "table", "junk")}
    assert kinds == {r.doc_id for r in rows("p10_found")[1]}
    cut = {(r.field_name, r.source_key, r.row_id) for r in rows("p4_scored")[1] if r.probability > 0.5}
    assert cut == set(map(tuple, rows("p4_found")[1])) and sum(r.n_cut for r in rows("p4_rates")[1]) == len(cut)
    matched = rows("p5_matches")[1]
    assert {(r.lang, r.lemma_id, r.lex_ref_link_id) for r in matched} == set(map(tuple, rows("p5_found")[1])) and all(0.55 <= r.confidence <= 1 for r in matched)
    assert len({r.lex_ref_link_id for r in matched}) == len(matched)
    unmapped = {r.typed_value for r in rows("p7_unmapped")[1]}
    assert {r.row_key for r in rows("p7_found")[1] if r.abbrev_id == 0 and r.source_table == "unmapped_summary"} <= unmapped


def test_containers_and_shares(rows):
    spots, size = {}, {"short": 256, "medium": 1024, "long": 4096}
    for r in rows("p8_packed")[1]:
        if r.container_id is not None:
            spots.setdefault((r.budget_name, r.container_id), []).append((r.start_token, r.n_tokens))
    for (budget, _), parts in spots.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= size[budget]
    for r in rows("p8_report")[1]:
        assert r.n_containers <= 1.05 * r.least_containers + 2 and 0 <= r.by_combination <= r.n_containers and r.fullest <= r.capacity_tokens
    for r in rows("p9_report")[1]:
        if r.target_share is not None and r.n_docs and r.n_docs > 20:
            assert abs(r.reached_share - r.target_share) < 0.05 and r.most_repeats <= r.max_repeats
