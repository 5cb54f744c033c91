import random

import numpy as np
import pytest

from stemma.llm import packing as P
from stemma.llm import tokens


def check(rows, capacity, sizes):
    by, seen = {}, {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append((r.piece_no, r.n_tokens))
        if r.container_id is None:
            assert r.n_tokens == 0
            continue
        by.setdefault(r.container_id, []).append((r.start_token, r.n_tokens))
    for doc, n in sizes.items():
        parts = sorted(seen[doc])
        assert sum(k for _, k in parts) == n and [i for i, _ in parts] == list(range(1, len(parts) + 1))
        assert len(parts) == max(1, -(-n // capacity))
    for parts in by.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))
    return len(by)


@pytest.mark.parametrize("capacity", [7, 64, 256])
def test_packs_all(spark, capacity):
    rnd = random.Random(capacity)
    sizes = {i: min(900, int(rnd.lognormvariate(3.5, 1))) for i in range(600)} | {9000 + i: 5 for i in range(300)}
    df = spark.createDataFrame([(i, n, "x") for i, n in sizes.items()], "doc_id bigint, n int, rank string")
    rows = P.pack(df, "doc_id", "n", {"a": capacity, "b": 2 * capacity}).collect()
    used = check([r for r in rows if r.budget == "a"], capacity, sizes)
    check([r for r in rows if r.budget == "b"], 2 * capacity, sizes)
    least = -(-sum(sizes.values()) // capacity)
    assert used <= least * 1.03 + 2


def test_edges(spark):
    df = spark.createDataFrame([(1, 0), (2, 10)], "doc_id bigint, n int")
    assert check(P.pack(df, "doc_id", "n", {"x": 4}).collect(), 4, {1: 0, 2: 10}) == 3
    assert P.pack(df.limit(0), "doc_id", "n", {"x": 4}).count() == 0
    assert P.pack(df, "doc_id", "n", {}).count() == 0
    for bad in (0, None):
        with pytest.raises(ValueError):
            P.pack(df, "doc_id", "n", {"x": bad})


def test_combinations_beat_greedy(spark):
    # the longest that fits puts 16 and 10 together and wastes four of thirty
    n = 500
    histogram = {16: n, 10: 3 * n, 9: n, 5: n}
    _, best, by_pattern = P.plan(histogram, 30)
    _, greedy, none = P.plan(histogram, 30, combine=False)
    assert best == 2 * n and by_pattern >= 0.95 * best and none == 0 and greedy > 2.15 * n


def test_searches_see_every_combination(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    for capacity in (9, 40, 97):
        gain = np.full(capacity + 1, -np.inf)
        lengths = np.unique(rnd.integers(1, capacity + 1, capacity // 2))
        gain[lengths] = rnd.normal(size=len(lengths))
        got = {r[0]: gain[r].sum() for r in P.three_lengths(gain, lengths, capacity)}
        have = set(lengths.tolist())
        for a in have:
            sums = [gain[a] + gain[b] + gain[capacity - a - b] for b in have if capacity - a - b in have]
            assert (a in got) == bool(sums) and (not sums or np.isclose(got[a], max(sums)))
        cols, times = P.repeated_lengths(gain, lengths, capacity)
        assert ((cols * times).sum(axis=1) == capacity).all()
        for a in have:
            fits = [k for k in range(1, capacity // a + 1) if capacity - k * a == 0 or capacity - k * a in have]
            assert (a in {int(x) for x in cols[:, 0]}) == bool(fits)
    here = P._search_three(None, gain, lengths, capacity)
    monkeypatch.setattr(P, "SPREAD_FROM", 1)
    spread = P._search_three(spark, gain, lengths, capacity)
    assert {tuple(r) for r in here.tolist()} == {tuple(r) for r in spread[spread[:, 0] > 0].tolist()}


def test_tokens(spark):
    df = spark.createDataFrame([("hello world",), (None,), ("",), ("<|endoftext|>",)], "t string")
    got = [r[0] for r in df.select(tokens.n_tokens(df.t)).collect()]
    assert got[:3] == [2, 0, 0] and got[3] > 1
