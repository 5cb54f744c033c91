import random

import pytest

from stemma.operators import hierarchy as H

DDL = "sense_id int, lang string, h_number string, parent_h_number string, last_updated int, node string"


def brute(parents):
    """(on_loop, path) of every node by walking."""
    out = {}
    for n in parents:
        seen, x = [], n
        while x is not None and x not in seen:
            seen.append(x)
            x = parents[x]
        out[n] = (x == n, None if x is not None else seen[::-1])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_walking(spark, seed):
    rnd = random.Random(seed)
    n = 60
    parents = {i: (rnd.choice([None, *range(n)]) if rnd.random() < 0.85 else None) for i in range(n)}
    parents |= {1000 + i: (1000 + i - 1 if i else None) for i in range(40)}  # a deep chain
    rows = [(i, "L", f"n{i}", None if p is None else f" N{p}" + " ", 1, "x") for i, p in parents.items()]
    nodes = H.nodes_of(spark.createDataFrame(rows, DDL), "lang", "h_number", "parent_h_number", "sense_id")
    want = brute(parents)
    assert {r.node for r in H.loop_nodes(nodes).collect()} == {i for i, (loop, _) in want.items() if loop}
    got = {r.node: r for r in H.hierarchy(nodes).collect()}
    assert len(got) == len(parents)
    for i, (loop, path) in want.items():
        if path is None:
            assert got[i].state == ("loop" if loop else "below_loop") and got[i].path is None
        else:
            assert got[i].path == path and got[i].depth == len(path) - 1 and got[i].root == path[0]
            assert got[i].n_below == sum(1 for _, q in want.values() if q and i in q[:-1])
    pairs = {(r.node, r.descendant, r.distance) for r in H.descendants(nodes).collect()}
    assert pairs == {(a, i, len(p) - 1 - k) for i, (_, p) in want.items() if p for k, a in enumerate(p[:-1])}


def test_odd_inputs(spark):
    rows = [
        (1, "A", "n1", "n1", 1, "v"),  # its own parent
        (2, "A", "n2", "gone", 1, None),  # parent names no row
        (3, "A", None, "n1", 1, None), (4, "A", "  ", "n1", 1, None),  # no name
        (5, "B", "N1 ", None, 1, None),  # other scope, same name
        (6, None, "n6", " n6" + "0", 1, None), (60, None, "n60", "n6", 2, None), (60, None, "n60", None, 1, None),
        (7, "A", "n7", "n2", 1, "a"), (7, "A", "n7", "n2", 1, "a"),  # delivered twice
    ]
    df = H.latest_versions(spark.createDataFrame(rows, DDL), "sense_id", "last_updated")
    assert df.count() == 8
    nodes = H.nodes_of(df, "lang", "h_number", "parent_h_number", "sense_id")
    got = {r.node: r.state for r in H.hierarchy(nodes).collect()}
    assert got == {1: "loop", 2: "tree", 5: "tree", 6: "loop", 60: "loop", 7: "tree"}
    status = {r.node: r.parent_status for r in nodes.collect()}
    assert status[2] == "missing" and status[5] == "none" and status[7] == "found"


def test_empty(spark):
    nodes = H.nodes_of(H.latest_versions(spark.createDataFrame([], DDL), "sense_id", "last_updated"), "lang", "h_number", "parent_h_number", "sense_id")
    assert H.hierarchy(nodes).count() == 0 and H.loop_nodes(nodes).count() == 0 and H.descendants(nodes).count() == 0
