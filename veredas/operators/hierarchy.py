"""Parent-child links of unknown depth to roots, depths, paths and cycles.

Every node has one pointer, to its parent. A deterministic hash makes about one
node in ``every`` a splitter. (1) Each node walks to its next splitter or root,
in strides that double. (2) The pointers between splitters form a reduced graph,
solved the same way. (3) A node's answer is its stretch to the splitter plus the
splitter's answer, which gives exact depths and paths. Nodes that never leave
are on or below a cycle; cycles without any splitter are caught by a counting
bound and handled with the others in a separate pass that names each cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import HOT, lookup_join


def _is_splitter(node: str, every: int):
    return F.pmod(F.xxhash64(F.lit("splitter"), F.col(node)), F.lit(every)) == 0


def pointers(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, up): one pointer per child; of several parents the smallest counts.

    Rows with a null child or parent are no links; repeated links count once.
    """
    return (
        edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
        .select(F.col(child).cast("string").alias("node"), F.col(parent).cast("string").alias("up"))
        .groupBy("node")
        .agg(F.min("up").alias("up"))
    )


def _chase(start: DataFrame, paths: bool) -> tuple[DataFrame, DataFrame]:
    """Follow (node, at, steps, seg, stop) until ``stop``, doubling the stride each round.

    Returns the stopped rows and the rows that can never stop. If a walk of more
    than 2^r steps existed without repeating a node, at least 2^(r-1) nodes would
    have been walking in the round before; fewer walkers than that are all cyclic.
    """
    moved = cut(start)
    done = moved.where("stop")
    going = moved.where(~F.col("stop"))
    walking, reached, before = going.count(), 1, None
    while walking and not (before is not None and before < reached // 2):
        # only the walkers are written again; who has stopped stays where it was written
        ahead = done.unionByName(going).select(
            F.col("node").alias("at"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("seg").alias("_seg"), F.col("stop").alias("_stop")
        )
        moved = cut(
            # fewer walkers than a hot key has rows need no count by key
            lookup_join(going, ahead, "at", how="inner", hot=None if walking >= HOT else []).select(
                "node",
                F.col("_at").alias("at"),
                (F.col("steps") + F.col("_steps")).alias("steps"),
                (F.concat("seg", "_seg") if paths else F.col("seg")).alias("seg"),
                F.col("_stop").alias("stop"),
            )
        )
        done, going = done.unionByName(moved.where("stop")), moved.where(~F.col("stop"))
        before, walking, reached = walking, going.count(), reached * 2
    return done, going


def _name_cycles(cyclic: DataFrame, links: DataFrame) -> DataFrame:
    """(node, cycle, on_cycle): the smallest node of the cycle that each node leads to.

    Only nodes on or below cycles take part. After at least as many steps as
    there are such nodes every walker stands on its cycle and has passed all of
    it, so the minimum over the steps walked from there names the cycle.
    """
    own = cut(links.join(cyclic.select("node"), "node", "left_semi").select("node", F.col("up").alias("at"), F.col("node").alias("low")))
    n, reached = own.count(), 1
    while reached < n:
        ahead = own.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("low").alias("_low"))
        own = cut(lookup_join(own, ahead, "at", how="inner", hot=None if n >= HOT else []).select("node", F.col("_at").alias("at"), F.least("low", "_low").alias("low")))
        reached *= 2
    lows = own.select(F.col("node").alias("at"), F.col("low").alias("cycle"))
    on = own.select(F.col("at").alias("node")).distinct().withColumn("on_cycle", F.lit(True))
    named = lookup_join(own.select("node", "at"), lows, "at", how="inner").select("node", "cycle")
    return named.join(on, "node", "left").select("node", "cycle", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))


def resolve_hierarchy(edges: DataFrame, child: str, parent: str, every: int = 8, paths: bool = False, name_cycles: bool = False) -> DataFrame:
    """(node, root, depth, path, cycle, on_cycle): one row per node that has a parent.

    ``depth`` counts the links from the root, the topmost parent without a parent
    of its own. ``path`` (with ``paths``) is the array root ... node. Nodes on or
    below a cycle have root and path null, depth -1 and, with ``name_cycles``, the
    smallest node of that cycle in ``cycle``; ``on_cycle`` tells the two apart.

    Edge cases: null ends are no links; a self link is a cycle of one; repeated
    links count once; of several parents the smallest is followed; an empty table
    gives no rows; further columns are never read.
    """
    links = cut(pointers(edges, child, parent))
    spark = links.sparkSession
    nodes = links.select(F.col("node").alias("up"), F.lit(True).alias("_inner"))
    seg = F.array("node") if paths else F.array().cast("array<string>")
    first = lookup_join(links, nodes, "up", how="left").select(
        "node",
        F.col("up").alias("at"),
        F.lit(1).cast("long").alias("steps"),
        seg.alias("seg"),
        F.coalesce("_inner", F.lit(False)).alias("_inner"),
    )
    walk = first.select("node", "at", "steps", "seg", (~F.col("_inner") | _is_splitter("at", every)).alias("stop"), "_inner")
    # where a walk stopped: at a root (no pointer of its own) or at a splitter
    stopped, lost = _chase(walk.drop("_inner"), paths)
    stopped = cut(stopped)
    inner = links.select(F.col("node").alias("at"), F.lit(True).alias("_more"))
    reduced = lookup_join(stopped.where(_is_splitter("node", every)), inner, "at", how="left").select(
        "node", "at", "steps", "seg", F.col("_more").isNull().alias("stop")
    )
    # a splitter that never stopped leads into a splitterless cycle: it points at itself
    stuck = lost.where(_is_splitter("node", every)).select("node", F.col("node").alias("at"), "steps", "seg", "stop")
    solved, looping = _chase(reduced.unionByName(stuck), paths)
    answers = solved.select(F.col("node").alias("at"), F.col("at").alias("_root"), F.col("steps").alias("_steps"), F.col("seg").alias("_seg"), F.lit(False).alias("_loop"))
    loops = looping.select(
        F.col("node").alias("at"), F.lit(None).cast("string").alias("_root"), F.lit(0).cast("long").alias("_steps"), F.array().cast("array<string>").alias("_seg"), F.lit(True).alias("_loop")
    )
    full = lookup_join(stopped, answers.unionByName(loops), "at", how="left")
    root = F.when(F.col("_loop").isNull(), F.col("at")).otherwise(F.col("_root"))
    upward = F.concat("seg", F.coalesce("_seg", F.array().cast("array<string>")))
    is_cyclic = F.coalesce("_loop", F.lit(False))
    done = full.where(~is_cyclic).select(
        "node",
        root.alias("root"),
        (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("depth"),
        (F.concat(F.array(root), F.reverse(upward)) if paths else F.lit(None).cast("array<string>")).alias("path"),
    )
    cyclic = full.where(is_cyclic).select("node").unionByName(lost.select("node"))
    if name_cycles:
        named = _name_cycles(cyclic, links)
    else:
        named = cyclic.select("node", F.lit(None).cast("string").alias("cycle"), F.lit(None).cast("boolean").alias("on_cycle"))
    none = spark.range(0).select(
        F.lit(None).cast("string").alias("node"), F.lit(None).cast("string").alias("root"), F.lit(-1).cast("long").alias("depth"),
        F.lit(None).cast("array<string>").alias("path"), F.lit(None).cast("string").alias("cycle"), F.lit(None).cast("boolean").alias("on_cycle"),
    )
    good = done.withColumns({"cycle": F.lit(None).cast("string"), "on_cycle": F.lit(None).cast("boolean")})
    bad = named.select("node", F.lit(None).cast("string").alias("root"), F.lit(-1).cast("long").alias("depth"), F.lit(None).cast("array<string>").alias("path"), "cycle", "on_cycle")
    return none.unionByName(good).unionByName(bad)


def descendants(resolved: DataFrame, ancestor: str = "ancestral", descendant: str = "descendente", distance: str = "distancia") -> DataFrame:
    """(ancestor, descendant, distance) for every pair on a path of ``resolve_hierarchy``.

    Pairs are rows, not one list per ancestor, so a root over a third of all
    nodes is no large record. Nodes on or below cycles have no path and no pairs.
    """
    up = resolved.where(F.col("path").isNotNull()).select("node", "depth", F.posexplode("path").alias("_at", ancestor))
    return up.where(F.col("_at") < F.col("depth")).select(ancestor, F.col("node").alias(descendant), (F.col("depth") - F.col("_at")).alias(distance))
