"""Walks over an edge table that may have cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .relational import top_per_group


def bounded_walk(seeds: DataFrame, steps: DataFrame, most: int = 8) -> DataFrame:
    """(node, depth, came_from, source): every node reached within ``most`` steps, at first arrival.

    ``seeds``: node. ``steps``: here, there, source. Level by level: only nodes
    not seen before go on, so a cycle costs one level and never multiplies.
    Ties of one level fall to the smallest (came_from, source). Seeds have depth
    0, no came_from and source ``semente``. Each level is cut to the shared
    folder; the loop ends with the level that reaches nothing new.

    Null nodes are no seeds and no steps; self steps lead nowhere; repeats count once.
    """
    start = seeds.where(F.col("node").isNotNull()).select("node").distinct()
    level = cut(start.select("node", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("came_from"), F.lit("semente").alias("source")))
    clean = cut(steps.where(F.col("here").isNotNull() & F.col("there").isNotNull() & (F.col("here") != F.col("there"))).select("here", "there", "source").distinct())
    levels, seen = [level], level.select("node")
    for depth in range(1, most + 1):
        reached = level.select(F.col("node").alias("here")).join(clean, "here").select(F.col("there").alias("node"), F.col("here").alias("came_from"), "source")
        fresh = reached.join(seen, "node", "left_anti")
        first = top_per_group(fresh, ["node"], [F.col("came_from"), F.col("source")])
        level = cut(first.select("node", F.lit(depth).alias("depth"), "came_from", "source"))
        if level.isEmpty():
            break
        levels.append(level)
        seen = seen.unionByName(level.select("node"))
    return reduce(DataFrame.unionByName, levels)


def simple_paths(steps: DataFrame, targets: DataFrame, most: int = 6) -> DataFrame:
    """(start, target, hops, trail): paths of 1 to ``most`` steps that end in a target.

    ``steps``: here, there (from owner to owned), ``targets``: node. A path uses
    no step twice. Paths are rows; their number can grow with the branching, so
    choose few targets.
    """
    moves = cut(steps.where(F.col("here").isNotNull() & F.col("there").isNotNull()).select("here", "there").distinct())
    at = targets.where(F.col("node").isNotNull()).select(F.col("node").alias("target"), F.col("node").alias("_at"), F.array().cast("array<string>").alias("_used"), F.array(F.col("node").cast("string")).alias("trail")).distinct()
    found = []
    for hops in range(1, most + 1):
        step = F.concat_ws(">", "here", "there")
        grown = at.join(moves, at["_at"] == moves["there"]).where(~F.array_contains("_used", step))
        at = cut(grown.select("target", F.col("here").alias("_at"), F.array_append("_used", step).alias("_used"), F.concat(F.array(F.col("here").cast("string")), "trail").alias("trail")))
        if at.isEmpty():
            break
        found.append(at.select(F.col("_at").alias("start"), "target", F.lit(hops).alias("hops"), "trail"))
    if not found:
        return at.select(F.col("_at").alias("start"), "target", F.lit(0).alias("hops"), "trail").where(F.lit(False))
    return reduce(DataFrame.unionByName, found)


def innermost(vias: DataFrame, owns: DataFrame, keys: list[str], via: str = "via") -> DataFrame:
    """The vias of each key that no other via of the same key owns.

    ``owns``: owner, owned. Two vias that own each other both go; see
    ``mutual_vias`` for how many that are. An anti-join on equi-keys.
    """
    pairs = vias.select(*keys, via).distinct()
    owned = pairs.select(*keys, F.col(via).alias("owner")).join(owns.where("owner != owned").select("owner", F.col("owned").alias(via)).distinct(), "owner").select(*keys, via)
    return pairs.join(owned, [*keys, via], "left_anti")


def mutual_vias(vias: DataFrame, owns: DataFrame, keys: list[str], via: str = "via") -> DataFrame:
    """Pairs of vias of one key that own each other, which ``innermost`` loses."""
    a = vias.select(*keys, F.col(via).alias("owner")).distinct()
    b = vias.select(*keys, F.col(via).alias("owned")).distinct()
    back = owns.select(F.col("owned").alias("owner"), F.col("owner").alias("owned"))
    return a.join(owns.where("owner != owned").select("owner", "owned").distinct(), "owner").join(b, [*keys, "owned"]).join(back, ["owner", "owned"], "left_semi")


def edge_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge ends that are no nodes yet."""
    ends = edges.select(F.col("here").alias("node")).unionByName(edges.select(F.col("there").alias("node"))).where("node is not null").distinct()
    return ends.join(nodes.select("node"), "node", "left_anti")


def without_incoming(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that no edge leads to."""
    return nodes.join(edges.select(F.col("there").alias("node")), "node", "left_anti")
