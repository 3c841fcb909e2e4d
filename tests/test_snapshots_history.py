from datetime import date, datetime

from pyspark.sql import functions as F

from veredas.operators.history import build_store, state_as_of, validity
from veredas.operators.snapshots import canonical, snapshot_changes

D = [date(2025, 1, 1), date(2025, 2, 5), date(2025, 3, 1), date(2025, 4, 2), date(2025, 5, 9), date(2025, 6, 1)]
SCHEMA = "data date, k string, v string, carregado timestamp, mudanca string"


def rows(spark, values):
    return spark.createDataFrame([(D[d] if d is not None else None, k, v, datetime(2025, 1, 1, h), "x") for d, k, v, h in values], SCHEMA)


def changes(spark, values):
    out = snapshot_changes(rows(spark, values), "data", ["k"], ["v"], "carregado")
    return sorted((str(r.data), r.k, r.mudanca) for r in out.collect())


def test_changes_kinds(spark):
    got = changes(spark, [(0, "a", "1", 1), (0, "b", "1", 1), (0, "n", None, 1), (1, "a", "2", 1), (1, "c", None, 1), (1, "n", None, 1), (2, "c", "", 1), (2, "n", None, 1)])
    assert got == [
        ("2025-02-05", "a", "changed"), ("2025-02-05", "b", "removed"), ("2025-02-05", "c", "added"),
        ("2025-03-01", "a", "removed"), ("2025-03-01", "c", "changed"),
    ]


def test_last_loaded_and_repeats_count_once(spark):
    got = changes(spark, [(0, "a", "1", 1), (1, "a", "9", 1), (1, "a", "1", 2), (1, "a", "1", 2), (None, "a", "5", 3), (1, None, "5", 3)])
    assert got == []


def test_changes_of_empty_and_single_delivery(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(0, "a", "1", 1)]) == []


def test_deliveries_come_from_the_whole_table(spark):
    df = rows(spark, [(0, "a", "1", 1), (2, "a", "1", 1)])
    whole = rows(spark, [(0, "z", "1", 1), (1, "z", "1", 1), (2, "z", "1", 1)])
    out = snapshot_changes(df, "data", ["k"], ["v"], "carregado", deliveries=whole)
    assert sorted((str(r.data), r.mudanca) for r in out.collect()) == [("2025-02-05", "removed"), ("2025-03-01", "added")]


def test_canonical_tells_null_empty_and_limits_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, ""), ("", None), (None, None)], "a string, b string")
    assert df.select(canonical("a", "b").alias("c")).distinct().count() == 5
    n = spark.sql("select -0.0D as a, 0.0D as b, double('nan') as c, double('nan') as d").select(
        (canonical("a") == canonical("b")).alias("zero"), (canonical("c") == canonical("d")).alias("nan")
    ).first()
    assert n.zero and n.nan


def versions(spark, values, every=4):
    store = build_store(rows(spark, values), "data", ["k"], {"v": F.col("v")}, "carregado", every)
    return sorted(((r.k, r.valor, str(r.valido_de), str(r.valido_ate)) for r in validity(store, ["k"]).collect()), key=str)


def brute(values):
    last = {}
    for d, k, v, h in values:
        if (d, k) not in last or h >= last[d, k][0]:
            last[d, k] = (h, v)
    days = sorted({d for d, *_ in values})
    out = []
    for k in {k for _, k, *_ in values}:
        run = None
        for i, d in enumerate([*days, None]):
            state = last.get((d, k), (0, "ABSENT"))[1] if d is not None else "END"
            if run and state != run[0]:
                out.append((k, run[0], str(D[run[1]]), str(D[d]) if d is not None else "None"))
                run = None
            if run is None and state not in ("ABSENT", "END"):
                run = (state, d)
    return sorted(out, key=str)


def test_validity_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    values = [(d, f"k{i}", rnd.choice(["1", "2", None]), 1) for i in range(40) for d in range(6) if rnd.random() < 0.7] + [(d, "z", "1", 1) for d in range(6)]
    for every in (1, 3, 4, 10):
        assert versions(spark, values, every) == brute(values)


def test_state_is_read_back_from_nearest_checkpoint(spark):
    values = [(0, "a", "1", 1), (1, "a", "2", 1), (2, "a", "2", 1), (0, "b", "x", 1), (2, "b", "x", 1), (3, "c", None, 1), (3, "a", "3", 1), (4, "a", "3", 1)]
    store = build_store(rows(spark, values), "data", ["k"], {"v": F.col("v")}, "carregado", 2).cache()
    want = [{"a": "1", "b": "x"}, {"a": "2"}, {"a": "2", "b": "x"}, {"a": "3", "c": None}, {"a": "3"}]
    for n, state in enumerate(want):
        got = {r.k: r.valor for r in state_as_of(store, ["k"], "d", n, 2).collect()}
        assert got == state


def test_history_of_empty_table(spark):
    assert versions(spark, []) == []
