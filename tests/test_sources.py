
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veredas.operators.quality import require_count, require_rows
from veredas.plans.graph import frozen_graph
from veredas.plans.staging import schema_of, stage
from veredas.sources import readers as r
from veredas.sources import writers as w
from veredas.streaming import land, staged_stream


def test_header_and_strings(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes('CNPJ_CIA;DENOM_SOCIAL;\n00.000.001/0001-00;"EMPRESA Á\nB";x\n7;só\n'.encode("latin-1"))
    df = r.read_strings(spark, r.CsvSource("t", "cvm", str(p), "ISO-8859-1", ";"))
    assert df.columns == ["CNPJ_CIA", "DENOM_SOCIAL", "_col_2"]
    assert [tuple(x) for x in df.collect()] == [("00.000.001/0001-00", "EMPRESA Á\nB", "x"), ("7", "só", None)]
    assert r.header_of("﻿a,,b".encode(), "UTF-8", ",") == ["a", "_col_1", "b"]
    assert r.file_digests(spark, str(p)).first().bytes == p.stat().st_size
    assert len(r.source_registry("/x")) == 16


def line(rec="01", bdi="02", market="010"):
    text = [" "] * 245
    for at, v in ((1, rec), (3, "20260111"), (11, bdi), (13, "PETR4"), (25, market), (109, "0000000003670"), (148, "00012")):
        text[at - 1 : at - 1 + len(v)] = v
    return "".join(text)


def test_fixed_width_and_archives(spark, tmp_path):
    lines = [line(), line(bdi="96"), line(market="070"), line(rec="00"), "01short"]
    (tmp_path / "q.txt").write_text("\n".join(lines), encoding="latin-1")
    got = r.read_quotations(spark, str(tmp_path / "q.txt")).collect()
    assert [tuple(x) for x in got] == [("20260111", "02", "PETR4", "010", "0000000003670", "00012")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x.TXT", "\n".join(lines))
    assert r.zip_members(spark, str(tmp_path / "z.zip"), "*.txt").count() == 5
    with pytest.raises(Exception, match="0 members"):
        r.zip_members(spark, str(tmp_path / "z.zip"), "none.csv").count()


def test_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"value": [{"Conta": "140220", "Saldo": "1"}, {"Conta": "9", "Saldo": "2"}]}))
    schema = T.StructType([T.StructField("Conta", T.StringType()), T.StructField("Saldo", T.StringType())])
    assert r.read_odata(spark, str(tmp_path / "1.json"), schema, F.col("Conta") == "140220").count() == 1
    (tmp_path / "2.json").write_text("{}")
    with pytest.raises(Exception, match="no array"):
        r.read_odata(spark, str(tmp_path / "2.json"), schema).count()
    pages = {"a": {"value": [1], "@odata.nextLink": "b"}, "b": {"value": [2], "odata.nextLink": None}}
    assert list(r.odata_pages("a", pages.get)) == [[1], [2]]
    with pytest.raises(ValueError):
        list(r.odata_pages("a", lambda u: {}))


def test_listed_companies(spark):
    pages = {1: {"results": [1], "page": {"totalPages": 2}}, 2: {"results": [2]}}
    assert list(r.numbered_pages(pages.get)) == [[1], [2]]
    with pytest.raises(ValueError):
        list(r.numbered_pages(lambda n: {}))
    df = spark.createDataFrame([(1, "191", "1", "a"), (2, "00.000.000/0001-91", "1", "b"), (3, "7", "2", "c"), (4, None, "1", "d")], "seq int, cnpj string, type string, name string")
    assert [(x.cnpj, x.name) for x in r.listed_companies(df, "seq").collect()] == [("00000000000191", "b")]


def test_fetch_retries():
    waits, calls = [], []

    def get(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError
        return b"ok"

    assert r.fetched("u", wait=waits.append, get=get) == b"ok" and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        r.fetched("u", 2, wait=waits.append, get=lambda u, t: (_ for _ in ()).throw(OSError()))


def test_small_readers(spark, tmp_path):
    df = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 3, "c")], "cnpj string, seq int, v string")
    assert sorted(x.v for x in r.last_arrival(df, "cnpj", "seq").collect()) == ["b", "c"]
    got = r.in_parallel(spark, df, "cnpj", lambda c: {"code": c} if c == "1" else None, T.StructType([T.StructField("code", T.StringType())]))
    assert [x.code for x in got.collect()] == ["1"]
    assert spark.range(1).select(r.page_token(a="1")).first()[0] == "eyJhIjoiMSJ9"
    path = w.write_table(df.withColumn("data", F.lit("2026-01-11").cast("date")), str(tmp_path), "staging", "t", ["data"], ["cnpj"])
    assert r.partition_of(spark, path, "data", "2026-01-11").count() == 3
    plan = r.partition_of(spark, path, "data", "2026-01-11")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data" in plan
    (tmp_path / "d.csv").write_text("tabela,coluna,chave,valor\na,b,01,x\n")
    assert r.read_dictionary(spark, str(tmp_path / "d.csv")).first().chave == "01"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 2)], "k string, v int")
    assert w.write_csv(df, str(tmp_path / "c"), ["k"], ["k"]) == 2
    assert [x.k for x in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        w.write_table(df, str(tmp_path), "marts", "x", schema=T.StructType([T.StructField("z", T.StringType())]))
    assert w.described(df, {"k": "key"}).schema["k"].metadata == {"comment": "key"}
    assert w.manifest(spark, [{"table": "t", "row_count": 2}]).first().loaded_at is not None
    w.write_json_manifest(str(tmp_path / "m.json"), {"b": 1, "a": "é"})
    assert json.loads((tmp_path / "m.json").read_text())["a"] == "é"
    assert w.layer_name(" marts ", "x") == "marts" and w.layer_name(None, "x") == "x"
    nodes = spark.createDataFrame([("1", 1, "a", None), ("1", 2, None, "z"), ("2", 1, "b", None)], "id string, o int, n string, m string")
    assert sorted(str(tuple(x)) for x in w.merged_nodes(nodes, "id", "o").collect()) == ["('1', 'a', 'z')", "('2', 'b', None)"]
    edges = spark.createDataFrame([("1", "2", 1), ("1", "2", 5), ("1", "9", 1)], "a string, b string, o int")
    assert w.matched_edges(edges, nodes, "a", "b", "id").count() == 2 and w.last_edges(edges, "a", "b", "o").where("b = '2'").first().o == 5


def test_requirements(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert require_count(require_rows(df, "t"), F.col("x") > 1, 1, "t") is df
    with pytest.raises(ValueError):
        require_rows(df.limit(0), "t")
    with pytest.raises(ValueError):
        require_count(df, F.col("x") > 1, 2, "t")


def test_frozen_graph(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({
        "nodes": [{"id": "1", "kind": "person"}, {"id": "1", "kind": "company"}, {"id": "2", "kind": "person"}],
        "edges": [{"from": "1", "to": "2", "kind": "person_owns", "pct_votos": 1.5}, {"from": "1", "to": "2", "kind": "company_owns", "pct_votos": 36.7}, {"from": "1", "to": "9"}, {"from": "2", "to": "1"}],
    }))
    nodes, edges = frozen_graph(spark.read.option("multiLine", True).json(str(tmp_path / "g.json")))
    assert {r.id: r.labels[0] for r in nodes.collect()} == {"1": "Empresa", "2": "Pessoa"}
    assert {(r["from"], r["to"]): r["name"] for r in edges.collect()} == {("1", "2"): "empresa 36.7%", ("2", "1"): "owns"}


def test_stream_of_deliveries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("entcgc,entnome,mercodigo\n191,Banco,1\n")
    run = lambda: land(staged_stream(spark, str(tmp_path / "in"), "stg_susep_dado_cadastral"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    run()
    (tmp_path / "in" / "2.csv").write_text("entcgc,entnome,mercodigo\n,Outra,2\n")
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((x.id_cnpj or "", x.nome) for x in out.collect()) == [("", "Outra"), ("00000000000191", "Banco")]
    assert [f.dataType for f in out.schema] == [f.dataType for f in schema_of("stg_susep_dado_cadastral")]


def test_latin_files_keep_their_columns(spark, tmp_path):
    text = list(line())
    for at, v in ((28, "AÇÃO PRÓXIMA"), (40, "PNÇ")):
        text[at - 1 : at - 1 + len(v)] = v
    (tmp_path / "q.txt").write_bytes("".join(text).encode("latin-1") + b"\n")
    assert tuple(r.read_quotations(spark, str(tmp_path / "q.txt")).first()) == ("20260111", "02", "PETR4", "010", "0000000003670", "00012")
    (tmp_path / "h.csv").write_bytes('Razão;"Situação; atual"\nÁgua Fé;ç\n'.encode("latin-1"))
    df = r.read_strings(spark, r.CsvSource("t", "cvm", str(tmp_path / "h.csv"), "ISO-8859-1", ";"))
    assert df.columns == ["Razão", "Situação; atual"] and tuple(df.first()) == ("Água Fé", "ç")
    (tmp_path / "u.csv").write_bytes("﻿Razão,b\nx,\n".encode())
    df = r.read_strings(spark, r.CsvSource("t", "b3", str(tmp_path / "u.csv")))
    assert df.columns == ["Razão", "b"] and tuple(df.first()) == ("x", None)
    (tmp_path / "e.csv").write_bytes(b"")
    assert r.read_strings(spark, r.CsvSource("t", "b3", str(tmp_path / "e.csv"))).count() == 0


def test_missing_raw_columns_fail(spark):
    raw = spark.createDataFrame([("191", "Banco")], "entcgc string, entnome string")
    with pytest.raises(ValueError, match="no raw column mercodigo"):
        stage(raw, "stg_susep_dado_cadastral")
    assert tuple(stage(raw, "stg_susep_dado_cadastral", optional=["mercodigo"]).first()) == (stage(raw, "stg_susep_dado_cadastral", optional=["mercodigo"]).first().ano, "00000000000191", "Banco", None)


def test_required_files_and_rebuilt_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError, match="b .*b.csv"):
        r.required_files({"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}, str(tmp_path / "to"))
    assert not (tmp_path / "to").exists()
    assert r.required_files({"a": str(tmp_path / "a.csv")}, str(tmp_path / "to")) == {"a": str(tmp_path / "to" / "a.csv")}
    assert (tmp_path / "to" / "a.csv").read_text() == "x\n"
    w.write_table(spark.range(3).toDF("k"), str(tmp_path), "raw", "t1", cluster_by=["k"])
    w.write_table(spark.range(0).toDF("k"), str(tmp_path), "raw", "t2")
    got = w.manifest_of_layer(spark, str(tmp_path), "raw", {"t1": {"source_url": "u", "as_of_date": "2026-01-11"}}).collect()
    assert [(x.table, x.row_count, x.source_url) for x in got] == [("t1", 3, "u"), ("t2", 0, None)]
    found = r.source_registry("/x", {"cad_cia_aberta": "2026-08-08"}, {"cad_cia_aberta": "https://example.org/cad.csv"})
    assert (found["cad_cia_aberta"].as_of_date, found["cad_cia_aberta"].source_url, found["bancos_2025"].as_of_date) == ("2026-08-08", "https://example.org/cad.csv", "")


def test_files_of_a_partition_have_narrow_ranges(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(4000).selectExpr("id % 2 as p", "id as k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = w.write_table(df.repartition(8), str(tmp_path), "staging", "t", ["p"], ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "staging" / "t" / "p=0").glob("*.parquet"))
    assert path.endswith("t") and len(files) > 1
    spans = sorted((s.min, s.max) for f in files for s in [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics])
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_the_shared_folder_is_made_up_for_local_masters_only(monkeypatch):
    from veredas import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
