import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veredas.operators import quality as q
from veredas.operators.prefixes import fuzzy_block_join, prefix_join
from veredas.operators.relational import cascade, distinct_counts, flag_exists, latest_group, ordered_concat, tagged_union, top_per_group, unique_keys
from veredas.operators.walk import bounded_walk, edge_ends, innermost, mutual_vias, simple_paths, without_incoming


def test_latest_group_compares_text(spark):
    df = spark.createDataFrame([("a", "99", 1), ("a", "100", 2), ("b", None, 3), (None, "1", 4)], "k string, v string, x int")
    assert [r.x for r in latest_group(df, "k", "v").collect()] == [1]


def test_top_unique_and_counts(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), (None, 5, "z")], "k string, o int, v string")
    assert sorted(str((r.k, r.v)) for r in top_per_group(df, ["k"], [F.col("o")]).collect()) == sorted(map(str, [("a", "y"), ("b", None), (None, "z")]))
    assert sorted(str(r.k) for r in unique_keys(df, "k", "v").collect()) == ["None", "b"]
    got = {(r.k, r.o): r.n for r in distinct_counts(df, ["k"], {"n": "v"}).collect()}
    assert got == {("a", 2): 2, ("a", 1): 2, ("b", 1): 0, (None, 5): 1}


def test_ordered_concat_keeps_repeats_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", 3, "x"), ("a", 0, None)], "k string, o int, t string")
    assert ordered_concat(df, ["k"], F.col("t"), [F.col("o")], "s").first().s == "x; y; x"


def test_flags_cascades_and_unions(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    other = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r.id: r.f for r in flag_exists(df, other, ["k"], "f").collect()} == {1: True, 2: False, 3: False}
    one = spark.createDataFrame([("a", "first")], "k string, v string")
    two = spark.createDataFrame([("a", "second"), ("c", "second")], "k string, w string")
    got = {r.id: r.n for r in cascade(df, [(one, ["k"], "v"), (two, ["k"], "w")], "n", F.lit("none")).collect()}
    assert got == {1: "first", 2: "none", 3: "second"}
    assert tagged_union({"x": df, "y": df.select("id")}).count() == 6


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab", max_size=4), max_size=6), st.lists(st.text("ab", max_size=4), max_size=6))
def test_prefix_join_is_the_naive_one(spark, a, b):
    left = spark.createDataFrame([(i, x) for i, x in enumerate(a)] + [(99, None)], "i int, x string")
    right = spark.createDataFrame([(i, x) for i, x in enumerate(b)] + [(99, None)], "j int, y string")
    got = sorted((r.i, r.j) for r in prefix_join(left, right, "x", "y").collect())
    assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x.startswith(y) or y.startswith(x))


def test_fuzzy_block(spark):
    names = ["ANA MARIA LIMA", "ANA MARIO LIMA", "ANA LIMA", "ANA MARIA SOUZA LIMA", "EVA MARIA LIMA", "ANA MARIA LIMA"]
    df = spark.createDataFrame([(n,) for n in names], "a string").distinct()
    got = sorted(tuple(r) for r in fuzzy_block_join(df, df.withColumnRenamed("a", "b"), "a", "b").collect())
    assert got == sorted([
        ("ANA MARIA LIMA", "ANA MARIO LIMA"), ("ANA MARIO LIMA", "ANA MARIA LIMA"), ("ANA MARIA LIMA", "ANA MARIA SOUZA LIMA"), ("ANA MARIA SOUZA LIMA", "ANA MARIA LIMA"),
    ])


def naive_walk(seeds, steps, most):
    seen = {s: (0, None, "semente") for s in seeds}
    level = dict.fromkeys(seeds)
    for depth in range(1, most + 1):
        found = {}
        for h, t, f in steps:
            if h in level and h != t and t not in seen:
                found[t] = min(found.get(t, (h, f)), (h, f))
        seen |= {t: (depth, *v) for t, v in found.items()}
        level = found
    return seen


def test_walk_on_random_cyclic_graphs(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        steps = [(f"n{rnd.randrange(25)}", f"n{rnd.randrange(25)}", rnd.choice("fv")) for _ in range(45)]
        df = spark.createDataFrame([*steps, (None, "x", "f"), *steps[:3]], "here string, there string, source string")
        for most in (2, 8):
            got = {r.node: (r.depth, r.came_from, r.source) for r in bounded_walk(spark.createDataFrame([("n0",), ("n1",), (None,)], "node string"), df, most).collect()}
            assert got == naive_walk(["n0", "n1"], steps, most)


def test_walk_cuts_a_long_chain(spark):
    df = spark.createDataFrame([(f"c{i}", f"c{i + 1}", "f") for i in range(12)], "here string, there string, source string")
    assert bounded_walk(spark.createDataFrame([("c0",)], "node string"), df).count() == 9
    assert bounded_walk(spark.createDataFrame([], "node string"), df).count() == 0


def test_paths_use_no_step_twice(spark):
    df = spark.createDataFrame([("p", "a"), ("a", "b"), ("b", "a")], "here string, there string")
    got = sorted((r.start, r.hops) for r in simple_paths(df, spark.createDataFrame([("b",)], "node string"), 6).collect())
    assert got == [("a", 1), ("b", 2), ("p", 2)]


def test_innermost_and_mutual(spark):
    vias = spark.createDataFrame([("p", "e", "x"), ("p", "e", "y"), ("q", "e", "m"), ("q", "e", "n"), ("r", "e", "x")], "k string, e string, via string")
    owns = spark.createDataFrame([("x", "y"), ("m", "n"), ("n", "m"), ("x", "x")], "owner string, owned string")
    assert sorted(tuple(r) for r in innermost(vias, owns, ["k", "e"]).collect()) == [("p", "e", "x"), ("r", "e", "x")]
    assert sorted({r.k for r in mutual_vias(vias, owns, ["k", "e"]).collect()}) == ["q"]


def test_edge_ends_and_degrees(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "node string")
    edges = spark.createDataFrame([("a", "c"), (None, "b")], "here string, there string")
    assert [r.node for r in edge_ends(edges, nodes).collect()] == ["c"]
    assert [r.node for r in without_incoming(nodes, edges).collect()] == ["a"]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, v int")
    assert q.not_null(df, "k").count() == 2 and q.unique(df, ["k"]).count() == 1 and q.unique(df, ["k", "v"]).count() == 1
    assert q.accepted_values(df, "k", ["b"]).count() == 2 and q.expression_is_true(df, "k = 'b'").count() == 2
    assert q.relationships(df, "k", spark.createDataFrame([("a",)], "id string"), "id").count() == 0
    want = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("w", T.DateType())])
    assert q.contract(df, want) == ["missing w", "v is int, not bigint"]
    out = q.run_checks(df, [q.Check("n", lambda d: q.not_null(d, "k"), where="v = 3"), q.Check("u", lambda d: q.unique(d, ["k"]), "warn")])
    assert sorted(tuple(r) for r in out.collect()) == [("n", "error", 2), ("u", "warn", 1)]
