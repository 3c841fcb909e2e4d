import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veredas.llm.mixing import Share, budgets, mixed, report
from veredas.llm.packing import best_fit, packed, usage
from veredas.llm.tokens import encoding, measured


@given(st.lists(st.integers(1, 100), max_size=60), st.sets(st.integers(20, 120), min_size=1, max_size=3))
def test_best_fit_fits(sizes, caps):
    sizes = [min(s, max(caps)) for s in sizes]
    where, capacity = best_fit(sizes, sorted(caps))
    load = [0] * len(capacity)
    for s, b in zip(sizes, where):
        load[b] += s
    assert all(0 < x <= c and c in caps for x, c in zip(load, capacity))
    assert all(not any(o >= x for o in caps if o < c) for x, c in zip(load, capacity))  # downsized as far as it goes


def test_best_fit_wastes_little():
    rnd = random.Random(1)
    sizes = [min(8192, int(rnd.lognormvariate(6, 1))) + 1 for _ in range(5000)]
    for caps in ([8192], [512, 2048, 4096, 8192]):
        _, capacity = best_fit([min(s, max(caps)) for s in sizes], caps)
        assert sum(min(s, max(caps)) for s in sizes) / sum(capacity) > 0.985


def test_packing_is_a_partition_of_every_text(spark):
    rows = [(i % 50, 10 + i % 37) for i in range(300)] + [(1000, 0), (1001, None), (None, 12), (2000, 250)]
    items = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, tokens long, container string")
    out = packed(items, {"um": {"p": 64}, "junto": {"p": 64, "g": 100}}, shard_items=100).toPandas()
    for plan, most in (("um", 64), ("junto", 100)):
        part = out[out.plano == plan]
        assert part.tokens.sum() == sum(n or 0 for _, n in rows)
        load = part.dropna(subset=["container"]).groupby("container").agg(t=("tokens", "sum"), c=("capacidade_tokens", "first"))
        assert (load.t <= load.c).all()
        big = part[part.doc_id == 2000].sort_values("pedaco")
        assert list(big.tokens) == [most] * (250 // most) + [250 % most] and list(big.inicio) == [k * most for k in range(len(big))]
        assert (part[part.doc_id < 50].pedaco == 0).all() and part[part.doc_id.isin([1000, 1001])].container.isna().all()
        assert len(part[part.doc_id < 50]) == 300
    assert packed(items.limit(0), {"um": {"p": 64}}).count() == 0
    assert usage(packed(items, {"um": {"p": 64}})).first().tokens == sum(n or 0 for _, n in rows)


def test_tokens_are_of_the_whole_text(spark):
    texts = ["", None, "Olá, mundo", "a" * 5000 + " fim", "<|endoftext|>"]
    got = [r.tokens for r in measured(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").coalesce(1), ["doc_id"]).orderBy("doc_id").collect()]
    assert got == [len(encoding().encode_ordinary(t)) if t else 0 for t in texts]


def test_budgets_fill_up():
    shares = [Share("m", "a", 0.5, 1, 0.5), Share("m", "b", 0.3, 2, 0.5), Share("m", "c", 0.2, 1, 0.5), Share("m", "none", 0.0, 1, 0.5)]
    got = budgets(shares, {"a": 1000, "b": 50, "c": 1000}, 1000)
    assert got["m", "b"] == 100 and round(got["m", "a"] + got["m", "c"] + 100) == 500 and round(got["m", "a"] / got["m", "c"], 6) == 2.5 and got["m", "none"] == 0


TARGETS = "mistura string, fracao_corpus double, source string, peso_alvo double, max_repeticoes long"


def test_mix_meets_shares_and_nests(spark):
    rnd = random.Random(2)
    docs = [(i, rnd.choice(["Fonte A", "fonte_a", "b", "b", "b", None, "c"]), rnd.randrange(1, 400)) for i in range(6000)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, source string, tokens long, mistura string")
    targets = spark.createDataFrame(
        [("m", 0.3, "fonte_a", 0.5, 1), ("m", 0.3, "b", 0.5, 1), ("n", 0.5, "fonte_a", 0.4, 3), ("n", 0.5, "b", 0.4, 1), ("n", 0.5, "c", 0.1, 4), ("n", 0.5, "nada", 0.1, 9), ("m", 0.3, None, 1.0, 1)], TARGETS
    )
    rows, wanted, available, corpus = mixed(df, targets)
    got = rows.cache()
    for r in report(spark, got, wanted, available, corpus).collect():
        if r.source != "nada":
            assert abs(r.tokens - r.tokens_orcados) <= 400, r
        assert r.mais_repetido <= r.max_repeticoes
    # a document has as many copies in the larger budget as in the smaller, or more
    p = got.where("source = 'b'").groupBy("doc_id").pivot("mistura", ["m", "n"]).agg(F.first("repeticoes")).fillna(0)
    order = got.where("source = 'b'").groupBy("mistura").agg(F.sum("tokens").alias("t")).orderBy("t").collect()
    small, large = order[0].mistura, order[1].mistura
    assert p.where(F.col(small) > F.col(large)).count() == 0


def test_mix_edge_cases(spark):
    targets = spark.createDataFrame([("m", 1.0, "a", 1.0, 2), ("z", 0.5, "a", 0.0, 1)], TARGETS)
    empty = spark.createDataFrame([], "doc_id long, source string, tokens long")
    assert mixed(empty, targets)[0].count() == 0
    one = spark.createDataFrame([(1, "a", 10), (2, "a", 0), (3, None, 30), (1, "a", 10)], "doc_id long, source string, tokens long")
    got = sorted((r.doc_id, r.repeticoes) for r in mixed(one, targets)[0].where("mistura = 'm'").collect())
    assert got == [(1, 2), (1, 2)]
    assert mixed(one, targets.limit(0))[0].count() == 0
