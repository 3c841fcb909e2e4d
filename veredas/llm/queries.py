"""Queries of the llm operators on the registry tables and the corpus, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, reachable
from .matching import match_companies, reliability
from .mixing import mixed, report, source_name
from .names import link_spellings, name_pairs
from .packing import packed, usage
from .reading import reading_levels
from .survivor import Bundle, surviving_records
from .tokens import measured


#: A match is reported from this confidence on. Names that lost their region keep most of it for "none", and
#: firms that no source knows stay far below.
ACCEPTED = 0.2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder}/{name}.parquet")


def _typed_names(spark: SparkSession, folder: str) -> DataFrame:
    partners = table(spark, folder, "stg_rf_socio").select(
        "nome", "documento", F.when(F.col("tipo") == "1", "o").when(F.col("tipo") == "2", "p").alias("hint")
    )
    person = F.upper("tipo_pessoa_acionista").rlike("F[ÍI]SICA|^PF$")
    holders = table(spark, folder, "stg_cvm_fre_posicao_acionaria").select(
        F.col("nome_acionista").alias("nome"), F.col("documento_acionista").alias("documento"),
        F.when(person, "p").when(F.upper("tipo_pessoa_acionista").rlike("JUR[ÍI]DICA|^PJ$"), "o").alias("hint"),
    )
    return partners.unionByName(holders)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_pairs(link_spellings(_typed_names(spark, folder), "nome", "documento", "hint"))


def p1_grupos(spark: SparkSession, folder: str) -> DataFrame:
    """Each spelling with its entity."""
    return link_spellings(_typed_names(spark, folder), "nome", "documento", "hint")


def _edge_survivors(spark: SparkSession, folder: str, *wanted: str) -> DataFrame:
    """One record per edge; share and citation first, then the role that fits the source, then the name.

    Only the ``wanted`` bundles are chosen (all, if none is named). The role gives way to the
    citation and to nothing else, so without it the others come out as they do beside it.
    """
    latest = -F.unix_date("data_referencia")
    source = F.when(F.col("fonte") == "fre", 0).when(F.col("fonte") == "qsa", 1).otherwise(2)
    share, cited = F.col("percentual_on"), F.col("fonte_documento")
    bundles = [
        Bundle("percentual", ("percentual_on", "percentual_total"), share.between(0, 100) & ~F.isnan(share), (latest, source)),
        Bundle("citacao", ("fonte_documento", "fonte"), cited.rlike("[0-9]$"), (source, latest)),
        Bundle("papeis", ("papel", "acionista_controlador", "qualificacao"), F.col("papel").isNotNull(), (source, latest)),
        Bundle("nome", ("origem_nome", "origem_documento"), F.col("origem_nome").isNotNull(), (F.col("origem_documento").isNull(), latest, source)),
    ]
    # the role follows from the source: a partner list knows partners, a filing knows shareholders; the citation's order is laid down, so it is settled first
    used = [b for b in bundles if not wanted or b.name in wanted]
    dependencies = [("fonte", "papel")] if {"citacao", "papeis"} <= {b.name for b in used} else []
    return surviving_records(table(spark, folder, "vinculos"), ["origem_id", "cnpj"], "id_vinculo", used, dependencies)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    several = _edge_survivors(spark, folder, "percentual", "citacao").where("n > 1")
    supplied = F.array(
        F.struct(F.lit("percentual_on").alias("campo"), F.col("percentual.id_vinculo").alias("id_vinculo")),
        F.struct(F.lit("fonte_documento").alias("campo"), F.col("citacao.id_vinculo").alias("id_vinculo")),
    )
    return several.select("origem_id", "cnpj", F.explode(supplied).alias("s")).select("origem_id", "cnpj", "s.*").where("id_vinculo is not null")


def p3_sobreviventes(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of every edge."""
    return _edge_survivors(spark, folder).select(
        "origem_id", "cnpj", "n", "percentual.percentual_on", "percentual.percentual_total", "citacao.fonte_documento", "citacao.fonte",
        "papeis.papel", "papeis.acionista_controlador", "papeis.qualificacao", "nome.origem_nome", "nome.origem_documento",
    )


def p6_confianca(spark: SparkSession, folder: str) -> DataFrame:
    """The likeliest company of every entry, with its confidence."""
    return match_companies(table(spark, folder, "stg_valor_ranking"), table(spark, folder, "stg_rf_empresa"), table(spark, folder, "stg_cvm_cia_aberta"))


def p6_calibracao(spark: SparkSession, folder: str) -> DataFrame:
    """How often the confidence is right, by tenth, on held-out listed companies."""
    return reliability(table(spark, folder, "stg_valor_ranking"), table(spark, folder, "stg_rf_empresa"), table(spark, folder, "stg_cvm_cia_aberta"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_confianca(spark, folder).where(F.col("confianca") >= ACCEPTED).select("posicao", "tabela", "chave")


def p8_empacotados(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in containers: one plan per capacity, and ``conjunto`` with all capacities together."""
    sizes = {r.recipiente: r.capacidade_tokens for r in table(spark, folder, "recipiente").where("capacidade_tokens > 0").collect()}
    plans = {name: {name: c} for name, c in sizes.items()} | {"conjunto": sizes}
    return packed(measured(table(spark, folder, "documents"), ["doc_id"]), plans)


def p8_aproveitamento(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers of each plan are."""
    return usage(p8_empacotados(spark, folder))


def _mixed(spark: SparkSession, folder: str):
    return mixed(measured(table(spark, folder, "documents"), ["doc_id", "source"]), table(spark, folder, "mistura_alvo"))


def p9_misturas(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of every mix and how often each comes."""
    return _mixed(spark, folder)[0]


def p9_participacoes(spark: SparkSession, folder: str) -> DataFrame:
    """Shares asked and reached."""
    return report(spark, *_mixed(spark, folder))


def p10_niveis(spark: SparkSession, folder: str) -> DataFrame:
    """Level, confidence and measures of every document with words."""
    return reading_levels(table(spark, folder, "documents"), table(spark, folder, "nivel_rotulo"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "nivel_rotulo")
    documents = table(spark, folder, "documents")
    asked = documents.where((F.col("n_chars") >= 400) & ~F.coalesce(F.col("source") == "anexo_tabular", F.lit(False)))
    levels = reading_levels(documents, labels).select("doc_id", "nivel")
    return levels.join(asked.select("doc_id"), "doc_id", "left_semi").join(labels.select("doc_id"), "doc_id", "left_anti")


# --- what must hold for every result, counted over whole tables ------------------
def p1_verificacao(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs out of order, repeated, or with a name that no table has."""
    pairs = cut(p1_found(spark, folder))
    names = _typed_names(spark, folder).where("nome is not null").select("nome").distinct()
    wrong = pairs.agg(F.count_if(F.col("nome_a") >= F.col("nome_b")).alias("fora_de_ordem"), (F.count(F.lit(1)) - F.count_distinct("nome_a", "nome_b")).alias("repetidos"))
    ends = pairs.select(F.col("nome_a").alias("nome")).unionByName(pairs.select(F.col("nome_b").alias("nome")))
    unknown = ends.join(names, "nome", "left_anti").agg(F.count(F.lit(1)).alias("desconhecidos"))
    # one row each
    return wrong.withColumn("_one", F.lit(1)).join(unknown.withColumn("_one", F.lit(1)), "_one").drop("_one")


def p6_verificacao(spark: SparkSession, folder: str) -> DataFrame:
    """By table: matches of unknown entries or records, entries matched to two companies, confidences that are none."""
    found = cut(p6_confianca(spark, folder))
    entries = table(spark, folder, "stg_valor_ranking").select(F.col("posicao").cast("long").alias("posicao")).distinct()
    keys = table(spark, folder, "stg_rf_empresa").select(F.lit("stg_rf_empresa").alias("tabela"), F.col("cnpj_basico").alias("chave")).unionByName(
        table(spark, folder, "stg_cvm_cia_aberta").select(F.lit("stg_cvm_cia_aberta").alias("tabela"), F.col("id_cvm").alias("chave"))
    )
    marked = found.join(entries.withColumn("_e", F.lit(1)), "posicao", "left").join(keys.distinct().withColumn("_k", F.lit(1)), ["tabela", "chave"], "left")
    return marked.groupBy("tabela").agg(
        F.count_if(F.col("_e").isNull()).alias("entradas_desconhecidas"), F.count_if(F.col("_k").isNull()).alias("chaves_desconhecidas"),
        F.when(F.col("tabela") == "stg_rf_empresa", F.count(F.lit(1)) - F.count_distinct("posicao")).otherwise(0).alias("entradas_repetidas"),
        F.count_if(~F.col("confianca").between(0, 1)).alias("confiancas_invalidas"),
    )


def p8_verificacao(spark: SparkSession, folder: str) -> DataFrame:
    """By plan: documents placed, containers above their capacity or of none that is permitted, documents cut in vain or not whole."""
    sizes = table(spark, folder, "recipiente").where("capacidade_tokens > 0")
    most = sizes.agg(F.max("capacidade_tokens")).first()[0] or 0
    limits = sizes.select(F.col("recipiente").alias("plano"), F.col("capacidade_tokens").alias("_most")).unionByName(spark.createDataFrame([("conjunto", most)], "plano string, _most long"))
    placed = cut(p8_empacotados(spark, folder).join(F.broadcast(limits), "plano"))
    tokens = measured(table(spark, folder, "documents"), ["doc_id"]).groupBy("doc_id").agg(F.sum("tokens").alias("_tokens"))
    items = placed.groupBy("plano", "doc_id", "_most").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.max(F.col("inicio") + F.col("tokens")).alias("e")).join(tokens, "doc_id", "left")
    whole = items.groupBy("plano").agg(
        F.count(F.lit(1)).alias("documentos"), F.count_if((F.col("n") > 1) & (F.col("t") <= F.col("_most"))).alias("cortados_em_vao"),
        F.count_if((F.col("t") != F.col("e")) | ~F.col("t").eqNullSafe(F.col("_tokens"))).alias("incompletos"),
    )
    known = F.broadcast(sizes.select(F.col("recipiente"), F.col("capacidade_tokens").alias("_c")))
    full = placed.where("container is not null").groupBy("plano", "recipiente", "container", "capacidade_tokens").agg(F.sum("tokens").alias("t")).join(known, "recipiente", "left")
    loads = full.groupBy("plano").agg(F.count_if(F.col("t") > F.col("capacidade_tokens")).alias("acima_da_capacidade"), F.count_if(~F.col("_c").eqNullSafe(F.col("capacidade_tokens"))).alias("nao_permitidos"))
    return whole.join(loads, "plano", "left").fillna(0)


def p9_verificacao(spark: SparkSession, folder: str) -> DataFrame:
    """By mix: sources asked, documents above their cap, of sources not asked, or counted twice."""
    rows = p9_misturas(spark, folder)
    targets = table(spark, folder, "mistura_alvo").where("source is not null and peso_alvo is not null and mistura is not null")
    asked = targets.select("mistura", source_name("source").alias("source"), F.col("max_repeticoes").alias("_most"))
    marked = rows.join(F.broadcast(asked), ["mistura", "source"], "left")
    per = marked.groupBy("mistura").agg(
        F.count_if(F.col("repeticoes") > F.col("_most")).alias("acima_do_teto"), F.count_if(F.col("_most").isNull()).alias("fora_da_mistura"),
        (F.count(F.lit(1)) - F.count_distinct("doc_id")).alias("repetidos"),
    )
    return targets.groupBy("mistura").agg(F.count(F.lit(1)).alias("fontes")).join(per, "mistura", "left").fillna(0)


def p10_verificacao(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a level, and those of them off the scale or repeated."""
    return p10_found(spark, folder).agg(
        F.count(F.lit(1)).alias("documentos"), F.count_if(~F.coalesce(F.col("nivel").between(1, 4), F.lit(False))).alias("fora_da_escala"), (F.count(F.lit(1)) - F.count_distinct("doc_id")).alias("repetidos")
    )


_ALL = (
    p1_found, p1_grupos, p3_found, p3_sobreviventes, p6_found, p6_confianca, p6_calibracao, p8_empacotados, p8_aproveitamento, p9_misturas, p9_participacoes, p10_found, p10_niveis,
    p1_verificacao, p6_verificacao, p8_verificacao, p9_verificacao, p10_verificacao,
)
QUERIES = {f.__name__: f for f in _ALL}

_P3 = """with r as (select *, case fonte when 'fre' then 0 when 'qsa' then 1 else 2 end as ordem from vinculos
      where origem_id is not null and cnpj is not null),
  g as (select origem_id, cnpj, count(*) as n from r group by all),
  pct as (select * from (select *, row_number() over (partition by origem_id, cnpj
      order by data_referencia desc nulls last, ordem, id_vinculo) as k from r
      where percentual_on between 0 and 100 and not isnan(percentual_on)) where k = 1),
  cit as (select * from (select *, row_number() over (partition by origem_id, cnpj
      order by ordem, data_referencia desc nulls last, id_vinculo) as k from r
      where regexp_matches(fonte_documento, '[0-9]$')) where k = 1)
"""

SQL: dict[str, str] = {
    "p1_verificacao": "select 0 as fora_de_ordem, 0 as repetidos, 0 as desconhecidos",
    "p6_verificacao": """select tabela, 0 as entradas_desconhecidas, 0 as chaves_desconhecidas, 0 as entradas_repetidas, 0 as confiancas_invalidas
        from (values ('stg_rf_empresa'), ('stg_cvm_cia_aberta')) t(tabela)""",
    "p8_verificacao": """select plano, (select count(distinct doc_id) from documents) as documentos, 0 as cortados_em_vao, 0 as incompletos, 0 as acima_da_capacidade, 0 as nao_permitidos
        from (select recipiente as plano from recipiente where capacidade_tokens > 0 union all select 'conjunto')""",
    "p9_verificacao": """select mistura, count(*) as fontes, 0 as acima_do_teto, 0 as fora_da_mistura, 0 as repetidos from mistura_alvo
        where source is not null and peso_alvo is not null and mistura is not null group by mistura""",
    "p10_verificacao": """select count(*) as documentos, 0 as fora_da_escala, 0 as repetidos from documents
        where n_chars >= 400 and coalesce(source, '') != 'anexo_tabular' and doc_id not in (select doc_id from nivel_rotulo where doc_id is not null)""",
    "p3_found": _P3 + """select p.origem_id, p.cnpj, 'percentual_on' as campo, id_vinculo from pct p join g using (origem_id, cnpj) where n > 1
        union all select c.origem_id, c.cnpj, 'fonte_documento', id_vinculo from cit c join g using (origem_id, cnpj) where n > 1""",
    "p3_sobreviventes": _P3 + """, pap as (select * from (select r.*, row_number() over (partition by r.origem_id, r.cnpj
            order by r.ordem, r.data_referencia desc nulls last, r.id_vinculo) as k
          from r left join cit c using (origem_id, cnpj)
          where r.papel is not null and (c.cnpj is null or exists (
            select 1 from r o where o.origem_id = r.origem_id and o.cnpj = r.cnpj and o.papel = r.papel and o.fonte is not distinct from c.fonte))) where k = 1),
        nom as (select * from (select *, row_number() over (partition by origem_id, cnpj
            order by origem_documento is null, data_referencia desc nulls last, ordem, id_vinculo) as k from r where origem_nome is not null) where k = 1)
        select g.origem_id, g.cnpj, g.n, pct.percentual_on, pct.percentual_total, cit.fonte_documento, cit.fonte,
          pap.papel, pap.acionista_controlador, pap.qualificacao, nom.origem_nome, nom.origem_documento
        from g left join pct using (origem_id, cnpj) left join cit using (origem_id, cnpj)
        left join pap using (origem_id, cnpj) left join nom using (origem_id, cnpj)""",
}
