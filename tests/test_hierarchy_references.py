import random
from datetime import date

from pyspark.sql import functions as F

from veredas.operators.hierarchy import descendants, resolve_hierarchy
from veredas.operators.references import orphan_references, parent_intervals
from veredas.operators.skew import hot_values, lookup_join, salted_join
from veredas.session import cut


def brute(up):
    out = {}
    for n in up:
        seen, x = [n], up[n]
        while x in up and x not in seen:
            seen.append(x)
            x = up[x]
        if x in seen:
            ring = seen[seen.index(x):]
            out[n] = (None, -1, None, min(ring), n in ring)
        else:
            out[n] = (x, len(seen), [x, *seen[::-1]], None, None)
    return out


def test_hierarchy_against_brute_force(spark):
    rnd = random.Random(1)
    up = {f"n{i}": f"n{max(0, i - 1)}" if i % 9 else f"r{rnd.randrange(4)}" for i in range(150)}
    up |= {f"c{i}": f"c{rnd.randrange(60)}" for i in range(60)} | {f"l{i}": f"l{i - 1}" for i in range(1, 120)}
    edges = spark.createDataFrame([(c, p, 1) for c, p in up.items()], "c string, p string, node int")
    for every in (3, 1000):
        got = {r.node: (r.root, r.depth, r.path, r.cycle, r.on_cycle) for r in resolve_hierarchy(edges, "c", "p", every, True, True).collect()}
        assert got == brute(up)


def test_hierarchy_edge_cases(spark):
    rows = [("a", "b"), ("a", "b"), ("a", "z"), (None, "b"), ("c", None), ("s", "s")]
    df = spark.createDataFrame(rows, "c string, p string")
    got = {r.node: (r.root, r.depth) for r in resolve_hierarchy(df, "c", "p").collect()}
    assert got == {"a": ("b", 1), "s": (None, -1)}
    assert resolve_hierarchy(df.limit(0), "c", "p", paths=True, name_cycles=True).count() == 0


def test_descendants_are_all_pairs_on_paths(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "b"), ("x", "y"), ("y", "x")], "c string, p string")
    got = sorted(tuple(r) for r in descendants(resolve_hierarchy(df, "c", "p", paths=True)).collect())
    assert got == [("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "c", 1), ("b", "d", 1)]


def test_references(spark):
    d = lambda m: date(2025, m, 1)
    parents = spark.createDataFrame([("a", d(1), None), ("b", d(5), None), ("c", d(1), d(3)), ("e", None, None), ("a", d(2), None), (None, d(1), None)], "k string, ini date, fim date")
    refs = spark.createDataFrame(
        [(1, "a", d(2)), (2, "b", d(2)), (3, "c", d(4)), (4, "x", d(1)), (5, None, d(1)), (6, "b", None), (7, "e", d(1)), (8, "x", None), (4, "x", d(1))], "id int, ref string, em date"
    )
    got = sorted((r.id, r.situacao) for r in orphan_references(refs, "ref", "em", parent_intervals(parents, "k", "ini", "fim")).collect())
    assert got == [(2, "late"), (3, "deleted"), (4, "missing"), (4, "missing"), (8, "missing")]
    assert orphan_references(refs.limit(0), "ref", "em", parent_intervals(parents, "k", "ini")).count() == 0
    assert orphan_references(refs, "ref", "em", parent_intervals(parents.limit(0), "k", "ini")).count() == 8


def test_hot_keys_meet_the_same_partners(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(999, None)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k1", 3)], "k string, v int")
    assert hot_values(left, "k", at_least=100) == ["hot"]
    for how in ("left", "inner"):
        plain = sorted(left.join(right, "k", how).select("id", "v").collect(), key=str)
        split = sorted(lookup_join(left, right, "k", how, hot=["hot"]).select("id", "v").collect(), key=str)
        salted = sorted(salted_join(left, right, ["k"], ["id"], F.coalesce(F.col("k") == "hot", F.lit(False)), 5, how).select("id", "v").collect(), key=str)
        assert plain == split
        if how == "inner":
            assert plain == salted


def test_rounds_of_a_loop_carry_no_constraints_or_estimates_on(spark):
    df = cut(spark.range(40).select("id", (F.col("id") % 3 == 0).alias("stop")))
    for _ in range(3):
        df = cut(df.where("stop").unionByName(df.where("not stop")).select("id", F.col("stop").alias("stop")))
        plan = df._jdf.queryExecution().optimizedPlan()
        assert plan.constraints().isEmpty()
        # what is not measured yet is not taken for small
        assert int(str(plan.stats().sizeInBytes())) > 10**12
    assert df.where("stop").count() == 14 and df.count() == 40
