import numpy as np
import pandas as pd

from stemma.llm import mixing as M
from stemma.llm import tokens

DDL = "doc_id bigint, source string, text string, times string"
TARGETS = "source string, target_share double, max_repeats int"
WORDS = {"a": ["horse", "bridge", "anchor"], "b": ["candle", "lamp", "feather"]}


def shares(rows):
    total = sum(r.n_tokens * r.times for r in rows)
    out = {}
    for r in rows:
        out[r.source] = out.get(r.source, 0) + r.n_tokens * r.times / total
    return out


def mixed(spark, docs, targets, **k):
    return M.mix(spark.createDataFrame(docs, DDL), "doc_id", "source", "text", spark.createDataFrame(targets, TARGETS), **k).collect()


def test_shares_and_caps(spark):
    docs = [(i, "big", "horse bridge " * (5 + i % 40), "x") for i in range(3000)] + [(10_000 + i, "small", "candle lamp " * 30, "x") for i in range(200)]
    docs += [(20_000 + i, "unused", None, "x") for i in range(20)] + [(30_000, "small", "", "x")]
    rows = mixed(spark, docs, [("big", 0.8, 1), ("small", 0.2, 3), ("absent", 0.0, 1)])
    assert len(rows) == len(docs) and {r.source for r in rows} == {"big", "small", "unused"}
    got = shares(rows)
    assert abs(got["big"] - 0.8) < 0.002 and abs(got["small"] - 0.2) < 0.002 and got.get("unused", 0) == 0
    assert max(r.times for r in rows if r.source == "small") == 3 and max(r.times for r in rows if r.source == "big") <= 1
    assert all(r.membership is None for r in rows if r.source == "unused") and all(0.9 < r.membership <= 1 for r in rows if r.source == "big")


def test_soft_members(spark):
    """Documents without source by their words, and documents that read like the other source stand between both."""
    rnd = np.random.default_rng(1)
    text = lambda k, n: " ".join(rnd.choice(WORDS[k], n))
    docs = [(i, "ab"[i % 2], text("ab"[i % 2], 15), "x") for i in range(400)]
    docs += [(1000 + i, None, text("ab"[i % 2], 10), "x") for i in range(200)]
    docs += [(2000 + i, "a", text("b", 15), "x") for i in range(20)]
    rows = mixed(spark, docs, [("a", 0.75, 1), ("b", 0.25, 1)], trust=0.8)
    unknown = [r for r in rows if 1000 <= r.doc_id < 2000]
    assert sum(r.source == "ab"[r.doc_id % 2] for r in unknown) >= 198
    by = {r.doc_id: r for r in rows}
    assert np.mean([by[2000 + i].membership for i in range(20)]) < np.mean([by[i].membership for i in range(0, 400, 2)]) - 0.05
    assert abs(shares(rows)["a"] - 0.75) < 0.01


def test_edges(spark):
    targets = [("a", 1.0, 2), (None, 0.5, 1)]
    assert mixed(spark, [], targets) == []
    one = [(1, "a", "x", "y")]
    assert [r.times for r in mixed(spark, one, targets)] == [2]
    assert [r.times for r in mixed(spark, one, [])] == [0]
    # no bound on repeats: as often as the other source needs, or once where nothing is bounded
    free = [r for i in range(40) for r in ((i, "a", "x y z", "y"), (100 + i, "b", "x y z", "y"))]
    got = mixed(spark, free, [("a", 0.8, None), ("b", 0.2, 1)])
    assert abs(shares(got)["a"] - 0.8) < 0.02 and max(r.times for r in got) >= 4
    assert sum(r.times for r in mixed(spark, free, [("a", 0.5, None), ("b", 0.5, None)])) in range(76, 85)


def test_descent_matches_a_direct_solution(spark):
    """Projected rates against a long plain descent on the same least squares in one place."""
    rnd = np.random.default_rng(5)
    n = rnd.integers(1, 90, 300)
    p = rnd.dirichlet([0.3, 0.3, 0.3], 300)
    own, caps = p.argmax(axis=1), np.array([1.0, 2.0, 3.0])
    df = spark.createDataFrame(pd.DataFrame({"own": own.astype("int32"), "n": n, "p": [x.tolist() for x in p]}), "own int, n bigint, p array<float>")
    goal = np.array([0.2, 0.3, 0.5]) * n.sum()
    gradients = M.descend(df.repartition(5), goal, caps)
    x, _ = M.follow(p, caps[own], gradients)
    assert np.abs((n * x) @ p - goal).max() < 2e-3 * goal.sum() and (x >= 0).all() and (x <= caps[own]).all()
    plain = np.minimum(1.0, caps[own])
    for _ in range(20_000):
        plain = np.clip(plain - p @ (((n * plain) @ p - goal) / n.sum()), 0, caps[own])
    assert np.abs((n * plain) @ p - goal).max() < 2e-3 * goal.sum()


def test_token_ids(spark):
    df = spark.createDataFrame([("hello world",), (None,), ("",)], "t string")
    got = [(len(r.i), r.n) for r in df.select(tokens.token_ids(df.t).alias("i"), tokens.n_tokens(df.t).alias("n")).collect()]
    assert got == [(2, 2), (0, 0), (0, 0)]
