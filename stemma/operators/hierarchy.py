"""Parent-child rows to full hierarchies by pointer doubling.

Every node carries a pointer to an ancestor and the path segment between the two.
A round joins each unresolved pointer with the pointer of its target, which doubles
the distance covered and concatenates the segments, so depth ``d`` takes
``log2(d)`` rounds.  Nodes whose pointer has reached a root leave the working set, and a round
reads of all nodes only those that are targets of the open pointers.  Few targets are broadcast, so nodes
that share one (all under one root, all hanging on one loop) stay where they are; of many, the
frequent ones are spread over tasks.
Nodes that never reach one hang on a loop; because ``f^m`` maps the unresolved set onto
the loops once ``m`` exceeds the longest tail, the set of pointer targets stops
shrinking exactly when it equals the nodes lying on loops themselves.

Defined results for odd inputs:

* null or blank key: the row is left out; null or blank parent, or a parent that names
  no row: the row is a root (``parent_status`` tells ``none`` from ``missing``);
* null scope is its own scope (nulls group together);
* several versions of one row (``version_of``): the latest by ``version_by`` counts,
  nulls oldest, remaining ties by the largest value of the other columns;
* two different rows with one name: the one with the smallest id names the node;
* a row that is its own parent lies on a loop of length one;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.session import cut, is_small, spread_join

#: Target ids of a round that are broadcast to find their pointers.
FEW = 100_000

BLANKS = " \t\r\n\u00a0"


def name_key(c: Column) -> Column:
    """Case and outer blanks do not tell names apart; a blank name is no name."""
    return F.nullif(F.lower(F.trim(c, F.lit(BLANKS))), F.lit(""))


def latest_versions(df: DataFrame, row_id: str, version_by: str) -> DataFrame:
    """One row per ``row_id``, the latest; rows without id are kept as they are."""
    rest = sorted(c for c in df.columns if c not in (row_id, version_by))
    packed = F.max(F.struct(F.col(version_by).alias("__version"), *[F.col(f"`{c}`") for c in rest])).alias("__s")
    known = df.where(F.col(row_id).isNotNull()).groupBy(row_id).agg(packed)
    known = known.select(
        row_id, F.col("__s.__version").alias(version_by), *[F.col("__s").getField(c).alias(c) for c in rest]
    ).select(*[f"`{c}`" for c in df.columns])
    return known.unionByName(df.where(F.col(row_id).isNull()).distinct())


def nodes_of(df: DataFrame, scope: str, key: str, parent: str, row_id: str) -> DataFrame:
    """(node, parent_node, scope_, key_, parent_status): one row per named node, parents resolved.

    ``node`` is the row id where there is one and a hash of the name below zero elsewhere.
    """
    named = df.select(
        F.coalesce(F.col(scope).cast("string"), F.lit("")).alias("scope_"),
        name_key(F.col(key)).alias("key_"),
        name_key(F.col(parent)).alias("parent_key"),
        F.coalesce(F.col(row_id).cast("long"), -F.abs(F.xxhash64(scope, name_key(F.col(key)))) - 1).alias("node"),
    ).where("key_ is not null")
    one = named.groupBy("scope_", "key_").agg(F.min(F.struct("node", "parent_key")).alias("s"))
    one = one.select("scope_", "key_", "s.node", "s.parent_key")
    target = one.select(
        F.col("scope_").alias("t_scope"), F.col("key_").alias("t_key"), F.col("node").alias("parent_node")
    )
    status = (
        F.when(F.col("parent_key").isNull(), "none").when(F.col("parent_node").isNull(), "missing").otherwise("found")
    )
    found = spread_join(one, target, [("scope_", "t_scope"), ("parent_key", "t_key")], ["node"])
    return found.select("node", "parent_node", "scope_", "key_", status.alias("parent_status"))


def resolve(nodes: DataFrame, max_rounds: int = 64) -> tuple[DataFrame, DataFrame]:
    """Return (resolved, unresolved).

    resolved: (node, anc, segment) where ``anc`` is the root and ``segment`` the node ids from
    the node up to, not including, the root.
    unresolved: (node, anc) for the nodes whose chain never ends, ``anc`` on the loop.
    """
    none = F.array().cast("array<bigint>")
    roots = nodes.where("parent_node is null").select("node", F.col("node").alias("anc"), none.alias("segment"))
    open_ = nodes.where("parent_node is not null").select(
        "node", F.col("parent_node").alias("anc"), F.array("node").alias("segment")
    )
    resolved, before = roots, None
    for _ in range(max_rounds):
        per_target = open_.groupBy("anc").agg(F.count(F.lit(1)).alias("c"))
        now = per_target.agg(F.sum("c"), F.count(F.lit(1))).first()
        if not now[0] or now == before:
            break
        before = now
        few = now[1] <= FEW
        targets = per_target.select(F.col("anc").alias("target"))
        # a resolved target hands over its root, an open one the whole jump it knows
        jump = resolved.withColumn("done", F.lit(True)).unionByName(open_.withColumn("done", F.lit(False)))
        jump = cut(jump.join(F.broadcast(targets) if few else targets, F.col("node") == F.col("target"), "left_semi").toDF("j_node", "j_anc", "j_segment", "done"))
        met = open_.join(F.broadcast(jump), F.col("anc") == F.col("j_node")) if is_small(jump) else spread_join(open_, jump, [("anc", "j_node")], ["node"], "inner")
        step = cut(met.select("node", F.col("j_anc").alias("anc"), F.concat("segment", "j_segment").alias("segment"), "done"))
        resolved = resolved.unionByName(step.where("done").drop("done"))
        open_ = step.where("not done").drop("done")
    return resolved, open_.select("node", "anc")


def loop_nodes(nodes: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node): every node that lies on a loop of parents itself.

    Here only open pointers are joined: one whose target is not open any more has met a root and goes.
    """
    open_ = nodes.where("parent_node is not null").select("node", F.col("parent_node").alias("anc"))
    before = None
    for _ in range(max_rounds):
        per_target = open_.groupBy("anc").agg(F.count(F.lit(1)).alias("c"))
        now = per_target.agg(F.sum("c"), F.count(F.lit(1))).first()
        if not now[0] or now == before:
            break
        before = now
        jump = open_.toDF("j_node", "j_anc")
        if now[1] <= FEW:
            # two numbers for each of few targets
            jump = F.broadcast(jump.join(F.broadcast(per_target.select(F.col("anc").alias("target"))), F.col("j_node") == F.col("target"), "left_semi"))
            met = open_.join(jump, F.col("anc") == F.col("j_node"))
        else:
            met = spread_join(open_, jump, [("anc", "j_node")], ["node"], "inner")
        open_ = cut(met.select("node", F.col("j_anc").alias("anc")))
    return open_.select(F.col("anc").alias("node")).distinct()


def hierarchy(nodes: DataFrame) -> DataFrame:
    """(node, root, depth, path, n_below, state) for every node.

    ``n_below`` counts the places of a node in the paths of others, as many as the paths themselves hold,
    summed before they are shuffled.

    ``path`` lists node ids from the root to the node; ``state`` is ``tree``, ``loop`` or
    ``below_loop``; the last two have null root, depth, path and n_below.
    """
    resolved, open_ = resolve(nodes)
    path = F.concat(F.array("anc"), F.reverse("segment"))
    tree = resolved.select("node", F.col("anc").alias("root"), F.size("segment").alias("depth"), F.when(F.col("node") == F.col("anc"), F.array("anc")).otherwise(path).alias("path"))
    below = (
        tree.where("depth > 0")
        .select(F.explode(F.slice("path", 1, F.col("depth"))).alias("up"))
        .groupBy("up")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tree = tree.join(below, F.col("node") == F.col("up"), "left").select(
        "node", "root", "depth", "path", F.coalesce("n", F.lit(0)).cast("long").alias("n_below"), F.lit("tree").alias("state")
    )
    on_loop = open_.select(F.col("anc").alias("l_node")).distinct()
    rest = open_.join(on_loop, F.col("node") == F.col("l_node"), "left").select(
        "node",
        F.lit(None).cast("long").alias("root"),
        F.lit(None).cast("int").alias("depth"),
        F.lit(None).cast("array<bigint>").alias("path"),
        F.lit(None).cast("long").alias("n_below"),
        F.when(F.col("l_node").isNotNull(), "loop").otherwise("below_loop").alias("state"),
    )
    return tree.unionByName(rest)


def descendants(nodes: DataFrame) -> DataFrame:
    """(node, descendant, distance): every pair of a node and a node below it in a tree."""
    resolved, _ = resolve(nodes)
    path = F.concat(F.array("anc"), F.reverse("segment"))
    return (
        resolved.where(F.size("segment") > 0)
        .select(F.col("node").alias("descendant"), F.size("segment").alias("depth"), F.posexplode(F.slice(path, 1, F.size("segment"))).alias("pos", "node"))
        .select("node", "descendant", (F.col("depth") - F.col("pos")).alias("distance"))
    )
