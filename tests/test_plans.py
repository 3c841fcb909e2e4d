"""Golden cases of the pipeline, with invented people and companies."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veredas.config import Config
from veredas.plans import graph as gp
from veredas.plans import marts, ownership, seeds, staging

DAY = date(2026, 1, 11)
CPF, MASK, CPF2 = "11122233344", "***222333**", "22233344455"


def frame(spark, schema: T.StructType, rows: list[dict]):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def model(spark, name, rows):
    return frame(spark, staging.schema_of(name), rows)


def fre(spark, rows):
    base = {"id_documento": "9", "data_referencia": DAY, "id_acionista": "1", "indicador_acionista_controlador": "N"}
    return model(spark, "stg_cvm_fre_posicao_acionaria", [base | r for r in rows])


def office(root, **more):
    return {"data": DAY, "cnpj_basico": root, "cnpj": root + "000100", "cnpj_ordem": "0001", "identificador_matriz_filial": "1", "situacao_cadastral": "02"} | more


def run(spark, filings=(), partners=(), companies=(), offices=()):
    return ownership.ownership_edges(
        fre(spark, filings), model(spark, "stg_rf_socio", [{"data": DAY} | r for r in partners]),
        model(spark, "stg_rf_empresa", [{"data": DAY} | r for r in companies]), model(spark, "stg_rf_estabelecimento", list(offices)),
    ).collect()


ISSUER = "10000001000100"


def person(name, document=None, issuer=ISSUER, **more):
    return {"id_cnpj": issuer, "nome_acionista": name, "documento_acionista": document, "tipo_pessoa_acionista": "PF"} | more


def test_owner_kinds(spark):
    filings = [
        {"id_cnpj": ISSUER, "nome_acionista": "Holding Alfa SA", "documento_acionista": "20000002000100", "tipo_pessoa_acionista": "PJ"},
        person("Ana Beatriz Couto", CPF), {"id_cnpj": ISSUER, "nome_acionista": "União Federal", "tipo_pessoa_acionista": "PJ"},
        {"id_cnpj": ISSUER, "nome_acionista": "Outros"}, {"id_cnpj": ISSUER, "nome_acionista": "Ações em Tesouraria"},
        {"id_cnpj": ISSUER, "nome_acionista": "Fundo X", "documento_acionista": "00000000000000", "nome_acionista_relacionado": "Y", "documento_acionista_relacionado": "00000000000000"},
        {"id_cnpj": ISSUER, "nome_acionista": "Sem Registro Ltda", "tipo_pessoa_acionista": "Jurídica"},
    ]
    partners = [
        {"cnpj_basico": "10000001", "tipo": "2", "nome": "JOAO DIAS", "documento": MASK, "qualificacao": "22"}, {"cnpj_basico": "10000001", "tipo": "2", "nome": "FORA", "qualificacao": "05"},
        {"cnpj_basico": "77777777", "tipo": "2", "nome": "SEM MATRIZ", "qualificacao": "22"}, {"cnpj_basico": "10000001", "tipo": "3", "nome": "FOREIGN LLC", "qualificacao": "37"},
    ]
    got = {r.origem_nome: r for r in run(spark, filings, partners, offices=[office("10000001"), office("10000001", cnpj="10000001000200", cnpj_ordem="0002", identificador_matriz_filial="2")])}
    kinds = {n: r.origem_tipo for n, r in got.items()}
    assert kinds == {
        "Holding Alfa SA": "empresa", "Ana Beatriz Couto": "pessoa", "União Federal": "estado", "Outros": "outros", "Ações em Tesouraria": "tesouraria", "Fundo X": "estrangeiro",
        "Sem Registro Ltda": "nao_resolvido", "JOAO DIAS": "pessoa", "FOREIGN LLC": "estrangeiro",
    }
    assert got["Ana Beatriz Couto"].origem_id == "p-ebdca308" and got["Outros"].origem_id == f"outros:OUTROS@{ISSUER}" and got["Fundo X"].via_cnpj is None
    assert got["JOAO DIAS"].cnpj == ISSUER and got["JOAO DIAS"].papel == "socio" and got["JOAO DIAS"].acionista_controlador is None and got["JOAO DIAS"].percentual_on is None


def test_unique_registry_name_gives_the_number(spark):
    companies = [{"cnpj_basico": "30000003", "razao_social": "BETA ENERGIA SA", "natureza_juridica": "2046"}, {"cnpj_basico": "30000004", "razao_social": "GAMA SA"}, {"cnpj_basico": "30000005", "razao_social": "GAMA SA"}]
    offices = [office("30000003"), office("30000004"), office("30000005")]
    filings = [{"id_cnpj": ISSUER, "nome_acionista": n, "tipo_pessoa_acionista": "PJ"} for n in ("Beta Energia S.A.", "Gama S.A.")]
    got = {r.origem_nome: (r.origem_tipo, r.origem_id) for r in run(spark, filings, companies=companies, offices=offices)}
    assert got == {"Beta Energia S.A.": ("empresa", "30000003000100"), "Gama S.A.": ("nao_resolvido", "nao_resolvido:GAMASA")}


def test_state_by_nature_beats_person_and_state_company_stays_company(spark):
    companies = [{"cnpj_basico": "40000001", "razao_social": "X", "natureza_juridica": "1015"}, {"cnpj_basico": "40000002", "razao_social": "Y", "natureza_juridica": "2038"}]
    filings = [person("Algum Orgao", "40000001000100"), {"id_cnpj": ISSUER, "nome_acionista": "Estatal", "documento_acionista": "40000002000100"}]
    got = {r.origem_nome: r.origem_tipo for r in run(spark, filings, companies=companies)}
    assert got == {"Algum Orgao": "estado", "Estatal": "empresa"}


OTHER = "10000009000100"


@pytest.mark.parametrize("rows, ids", [
    ([person("ANA LIMA COUTO", CPF), person("ANA LIMA COUTO", MASK, OTHER)], ["p-ebdca308", "p-ebdca308"]),
    ([person("JOÃO LIMA", CPF), person("JOAO LIMA", MASK, OTHER)], ["p-ebdca308", "p-ebdca308"]),
    ([person("RUI LAS-CASAS", CPF), person("RUI LAS CASAS", MASK, OTHER)], ["p-ebdca308", "p-ebdca308"]),
    ([person("EVA REIS", MASK), person("EVA REIS", MASK, OTHER)], ["nome:EVA REIS", "nome:EVA REIS"]),
    ([person("IVO MELO"), person("IVO MELO", None, OTHER)], [f"nome:IVO MELO@{ISSUER}", f"nome:IVO MELO@{OTHER}"]),
    ([person("IVO MELO BRAGA"), person("IVO MELO BRAGA", None, OTHER)], ["nome:IVO MELO BRAGA"] * 2),
    ([person("LIA MARIA PENA ROSA", CPF), person("LIA PENA ROSA", None, OTHER)], ["p-ebdca308"] * 2),
    ([person("LIA MARIA ROSA", CPF), person("LIA MARIO ROSA", None, OTHER)], ["p-ebdca308"] * 2),
    ([person("LIA MARIA ROSA", CPF), person("LIA CARLA ROSA", MASK, OTHER)], ["p-ebdca308"] * 2),
    ([person("LIA MARIA PENA ROSA", CPF), person("LIA JOANA PENA ROSA", CPF2), person("LIA PENA ROSA", None, OTHER)], ["p-baf57df5", "p-ebdca308", "nome:LIA PENA ROSA"]),
    ([person("UNO DOIS", CPF), person("UNO DOIS", "***999999**", OTHER)], ["p-ebdca308"] * 2),  # one number wins over a mask that differs
    ([person("UNO DOIS", MASK), person("UNO DOIS", None, OTHER)], ["nome:UNO DOIS"] * 2),  # one mask gives all rows of the name one id
])
def test_persons(spark, rows, ids):
    assert sorted(r.origem_id for r in run(spark, rows)) == sorted(ids)


EDGE = T.StructType([T.StructField(c, T.BooleanType() if c.startswith(("acionista", "participante", "tem_")) else T.DoubleType() if c.startswith("perc") else T.DateType() if c == "data_referencia" else T.StringType()) for c in ownership.EDGE])
SEED = "cnpj string, razao_social string, capital_social double, motivo_entrada_categoria string, motivo_entrada_descricao string, motivo_entrada_date date"


def edges_of(spark, rows):
    return frame(spark, EDGE, [{"origem_tipo": "empresa", "fonte": "fre", "id_documento": "9", "data_referencia": DAY, "papel": "acionista", "fonte_documento": "x"} | r for r in rows])


def c(n):
    return f"{n:08d}000100"


def seeds_of(spark, *ns):
    return spark.createDataFrame([(c(n), f"S{n}", 1.0, "semente", "lista", DAY) for n in ns], SEED)


def test_walk_passes_holdings_and_vehicles(spark):
    edges = edges_of(spark, [{"cnpj": c(1), "origem_id": c(2)}, {"cnpj": c(2), "origem_id": c(3)}, {"cnpj": c(3), "origem_id": c(1)}, {"cnpj": c(1), "origem_tipo": "pessoa", "origem_id": "p-1", "via_cnpj": c(4)}])
    got = {r.cnpj: (r.profundidade, r.cnpj_origem, r.fonte_chegada) for r in marts.walk_up(edges, seeds_of(spark, 1)).collect()}
    assert got == {c(1): (0, None, "semente"), c(2): (1, c(1), "fre"), c(4): (1, c(1), "via"), c(3): (2, c(2), "fre")}


def test_companies_mart(spark):
    edges = edges_of(spark, [{"cnpj": c(1), "origem_id": c(2), "origem_nome": "Dona"}, {"cnpj": c(1), "origem_tipo": "pessoa", "origem_id": "p-1", "via_cnpj": c(4)}])
    walk = marts.walk_up(edges, seeds_of(spark, 1))
    registry = model(spark, "stg_rf_empresa", [{"data": DAY, "cnpj_basico": c(4)[:8], "razao_social": "VEICULO", "capital_social": 5.0}])
    got = {r.cnpj: (r.razao_social, r.motivo_entrada_categoria, r.motivo_entrada_descricao) for r in marts.companies_mart(seeds_of(spark, 1), edges, walk, registry).collect()}
    assert got[c(1)] == ("S1", "semente", "lista") and got[c(2)] == ("Dona", "subida", f"FRE id_documento 9 da companhia {c(1)}")
    assert got[c(4)] == ("VEICULO", "subida", f"FRE Acionista_Relacionado da companhia {c(1)}")


def test_edges_mart_photocopies_and_innermost_vehicle(spark):
    edges = edges_of(spark, [
        {"cnpj": c(1), "origem_id": c(2), "via_cnpj": c(3)}, {"cnpj": c(3), "origem_id": c(2)},  # a copy: the owner owns the vehicle
        {"cnpj": c(1), "origem_id": c(3)}, {"cnpj": c(4), "origem_id": c(3)},
        {"cnpj": c(1), "origem_tipo": "pessoa", "origem_id": "p-1", "via_cnpj": c(3), "percentual_on": 5.0}, {"cnpj": c(1), "origem_tipo": "pessoa", "origem_id": "p-1", "via_cnpj": c(4), "percentual_on": 5.0},
        {"cnpj": c(1), "origem_tipo": "estado", "origem_id": "estado:UNIAO"},
    ])
    served = marts.edges_mart(edges, marts.walk_up(edges, seeds_of(spark, 1))).collect()
    got = {(r.origem_id, r.cnpj): r.percentual_on for r in served}
    assert set(got) == {(c(3), c(1)), (c(2), c(3)), (c(3), c(4)), ("p-1", c(3)), ("estado:UNIAO", c(1))}
    assert got["p-1", c(3)] is None


def test_persons_mart_takes_the_number_from_any_edge(spark):
    edges = edges_of(spark, [{"cnpj": c(1), "origem_tipo": "pessoa", "origem_id": "p-1", "origem_nome": "ANA", "origem_documento": MASK}, {"cnpj": c(8), "origem_tipo": "pessoa", "origem_id": "p-1", "origem_nome": "ANA", "origem_documento": CPF}, {"cnpj": c(1), "origem_id": c(2)}])
    served = marts.edges_mart(edges, marts.walk_up(edges, seeds_of(spark, 1)))
    assert [tuple(r) for r in marts.persons_mart(served, edges).collect()] == [("p-1", "ANA", CPF)]


def test_seeds_by_exact_name_prefix_and_register(spark):
    lists = "ano long, posicao long, nome string, razao_social string"
    ranking = spark.createDataFrame([(1, 1, "Alfa", "Cia. Alfa"), (1, 2, "Beta", "BETA MINERACAO"), (1, 3, "So Registro", None), (1, 4, "Ninguem Conhece", None)], lists)
    banks = spark.createDataFrame([(1, 7, "Alfa", "COMPANHIA ALFA")], lists)
    companies = model(spark, "stg_rf_empresa", [{"data": DAY, "cnpj_basico": f"5000000{i}", "razao_social": n, "capital_social": k} for i, (n, k) in enumerate([("COMPANHIA ALFA", 1.0), ("COMPANHIA ALFA", 9.0), ("BETA MINERACAO DO SUL SA", 2.0)])])
    listed = model(spark, "stg_cvm_cia_aberta", [{"id_cnpj": "60000000000100", "razao_social": "SO REGISTRO", "situacao": "ATIVO"}, {"id_cnpj": "10000000000100", "razao_social": "SO REGISTRO", "situacao": "CANCELADA"}])
    got = {r.cnpj: r.motivo_entrada_descricao for r in seeds.seed_companies(ranking, banks, banks.limit(0), companies, model(spark, "stg_rf_estabelecimento", [office(f"5000000{i}") for i in range(3)]), [(listed, "razao_social", "situacao")], Config(exceptions=(("Ninguem Conhece", "90000000000100"),))).collect()}
    title = "Valor 1000 2025, "
    assert got == {
        "50000001000100": f"{title}ranking industrial, posição 1; {title}bancos, posição 7", "50000002000100": f"{title}ranking industrial, posição 2",
        "60000000000100": f"{title}ranking industrial, posição 3", "90000000000100": f"{title}ranking industrial, posição 4",
    }


def test_graph(spark):
    edges = edges_of(spark, [
        {"cnpj": c(1), "origem_id": c(2), "origem_nome": "H", "papel": "acionista_controlador"}, {"cnpj": c(2), "origem_tipo": "pessoa", "origem_id": "p-1", "origem_nome": "ANA", "papel": "acionista_controlador"},
        {"cnpj": c(1), "origem_tipo": "estado", "origem_id": c(2), "origem_nome": "UNIAO"}, {"cnpj": c(1), "origem_tipo": "outros", "origem_id": "outros:1", "origem_nome": "Outros"},
    ])
    served, walk = marts.edges_mart(edges.limit(0), marts.walk_up(edges, seeds_of(spark, 1))).unionByName(edges.select(*marts.SERVED)), marts.walk_up(edges, seeds_of(spark, 1))
    registry = model(spark, "stg_rf_empresa", [])
    companies = marts.companies_mart(seeds_of(spark, 1), edges, walk, registry)
    nodes, links = gp.graph_nodes(companies, marts.persons_mart(served, edges), served), gp.graph_edges(served)
    assert {(r.id, r.labels[0]) for r in nodes.collect()} == {(c(1), "Empresa"), (c(2), "Empresa"), (c(2), "Estado"), ("p-1", "Pessoa"), ("outros:1", "Parada")}
    assert [(r.origem, r.hops) for r in gp.control_paths(nodes, links, c(1)).collect()] == [("Estado", 1), ("Pessoa", 2)]
    assert gp.owners_of(nodes, links, c(1)).count() == 3 and gp.owners_of(nodes, links, c(9)).count() == 0
    assert {r.label: r.n for r in gp.label_histogram(nodes).collect()}["Holding"] == 1
    checks = {r.verificacao: r.ok for r in gp.graph_checks(nodes, links, served).collect()}
    assert checks["edges equal served rows"] and checks["the Union is no person"] and not checks["edges SOCIO"]
    assert gp.graph_edges(served, nodes).count() == links.count() and gp.graph_edges(served, nodes.where("id != 'p-1'")).count() == links.count() - 1
    assert gp.graph_edges(served, nodes.where(F.col("id") != c(1))).count() == 1
    assert {r.id: tuple(r)[1:] for r in gp.owner_counts(nodes, links).collect()} == {c(1): (3, 1, 1), c(2): (1, 1, 0)}
    report = gp.owners_report(nodes, links, c(1), 2).collect()
    assert [(r.ordem, r.rel) for r in report] == [(1, "ACIONISTA"), (2, "ACIONISTA"), (3, None)] and report[2].descricao == "… 1 more"
    assert gp.owners_report(nodes, links, c(1), 14).count() == 3 and gp.owners_report(nodes, links, c(9)).count() == 0
    about = {r.verificacao: r.ok for r in gp.company_checks(nodes, links, c(1), [("Estado", "UNI"), ("Pessoa", "ANA")], [("Pessoa", "ANA")], True).collect()}
    assert list(about.values()) == [True, True, False, True, True]
    gp.require_checks(gp.company_checks(nodes, links, c(1), [("Estado", "UNI")]))
    with pytest.raises(ValueError, match="has a Pessoa like ANA"):
        gp.require_checks(gp.company_checks(nodes, links, c(1), [("Pessoa", "ANA")]))
    union = nodes.unionByName(nodes.where("id = 'p-1'").withColumn("id", F.lit("p-2")).withColumn("name", F.lit("PEDRO DA UNIÃO")))
    assert not {r.verificacao: r.ok for r in gp.graph_checks(union, links, served).collect()}["the Union is no person"]


def test_staging_contracts_and_values(spark):
    assert len(staging.MODELS) == 19
    for name in staging.MODELS:
        raw = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in {"unknown", *(s for s, _, _ in staging.columns_of(name))}]))
        assert [(f.name, f.dataType) for f in staging.stage(raw, name).schema] == [(f.name, f.dataType) for f in staging.schema_of(name)]
    raw = spark.createDataFrame([("20260111", "PETR4 ", "02", "010", "0000000003670", "12")], "DATA_PREGAO string, CODNEG string, CODBDI string, TPMERC string, PREULT string, NUMNEG string")
    row = staging.stage(raw, "stg_b3_cotahist").first()
    assert (str(row.data_pregao), row.ticker, float(row.preco_fechamento), row.quantidade_negocio) == ("2026-01-11", "PETR4", 36.7, 12)
    bank = staging.stage(spark.createDataFrame([("01-31-2026", "1", "2")], "Data string, CodInst string, CnpjInstituicaoLider string"), "stg_bcb_ifdata_cadastro", optional=["CodConglomeradoPrudencial", "NomeInstituicao", "Situacao"]).first()
    assert bank.ano_mes == "202601" and bank.cnpj_basico_lider == "00000002"
    assert staging.describe_models(spark).where(F.col("modelo") == "stg_cvm_cia_aberta").count() == 47
