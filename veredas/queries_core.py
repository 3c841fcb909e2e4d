"""Queries of the general operators on the registry tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.hierarchy import descendants, resolve_hierarchy
from .operators.history import build_store, state_as_of, validity
from .operators.references import orphan_references, parent_intervals
from .operators.snapshots import snapshot_changes
from .session import cut, reachable

CITATION = r"id_documento=(\d+)$"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder}/{name}.parquet")


def _partners(spark: SparkSession, folder: str) -> DataFrame:
    """Partner rows with a usable document: not null, not all zeros."""
    s = table(spark, folder, "stg_rf_socio")
    return s.where(F.col("documento").isNotNull() & ~F.col("documento").rlike("^0+$"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    out = snapshot_changes(_partners(spark, folder), "data", ["cnpj_basico", "documento"], ["qualificacao"], "carregado_em", deliveries=table(spark, folder, "stg_rf_socio"))
    return out.select(F.date_format("data", "yyyy-MM-dd").alias("data"), "cnpj_basico", "documento", "mudanca")


def p2_resumo(spark: SparkSession, folder: str) -> DataFrame:
    """Changes per delivery and kind."""
    return p2_found(spark, folder).groupBy("data", "mudanca").agg(F.count(F.lit(1)).alias("n"))


def _control(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "vinculos").where(F.col("acionista_controlador"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    out = resolve_hierarchy(_control(spark, folder), "cnpj", "origem_id")
    return out.select(F.col("node").alias("cnpj"), F.coalesce("root", F.lit("ciclo")).alias("raiz"), F.col("depth").alias("profundidade"))


def p4_caminhos(spark: SparkSession, folder: str) -> DataFrame:
    """Each company with its full path, and the cycle it is on or below."""
    out = resolve_hierarchy(_control(spark, folder), "cnpj", "origem_id", paths=True, name_cycles=True)
    return out.select(
        F.col("node").alias("cnpj"), F.col("root").alias("raiz"), F.col("depth").alias("profundidade"),
        F.array_join("path", " > ").alias("caminho"), F.col("cycle").alias("ciclo"), F.col("on_cycle").alias("no_ciclo"),
    )


def p4_descendentes(spark: SparkSession, folder: str) -> DataFrame:
    return descendants(resolve_hierarchy(_control(spark, folder), "cnpj", "origem_id", paths=True))


def _histories(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, list[str]]]:
    companies = table(spark, folder, "stg_rf_empresa")
    cents = F.expr("try_cast(capital_social as decimal(30,2))")
    partners = _partners(spark, folder)
    return {
        "stg_rf_empresa": (build_store(companies, "data", ["cnpj_basico"], {"capital_social": cents}, "carregado_em"), ["cnpj_basico"]),
        "stg_rf_socio": (
            build_store(partners, "data", ["cnpj_basico", "documento"], {"qualificacao": F.col("qualificacao")}, "carregado_em", deliveries=table(spark, folder, "stg_rf_socio")),
            ["cnpj_basico", "documento"],
        ),
    }


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, (store, keys) in _histories(spark, folder).items():
        versions = validity(cut(store), keys)
        document = F.col("documento") if "documento" in keys else F.lit("")
        parts.append(
            versions.select(
                F.lit(name).alias("tabela"), "cnpj_basico", document.alias("documento"),
                F.date_format("valido_de", "yyyy-MM-dd").alias("valido_de"),
                F.coalesce(F.date_format("valido_ate", "yyyy-MM-dd"), F.lit("")).alias("valido_ate"),
            )
        )
    return parts[0].unionByName(parts[1])


def p5_estado(spark: SparkSession, folder: str, ord_: int = 6) -> DataFrame:
    """Partner qualifications as of the seventh delivery, read back from the store."""
    store, keys = _histories(spark, folder)["stg_rf_socio"]
    return state_as_of(cut(store), keys, str(ord_), ord_).select("cnpj_basico", "documento", F.col("valor").alias("qualificacao"))


def _references(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame, DataFrame]]:
    edges = table(spark, folder, "vinculos").select("id_vinculo", "cnpj", "fonte_documento", "data_referencia")
    companies = parent_intervals(table(spark, folder, "empresas"), "cnpj", "motivo_entrada_date")
    filings = table(spark, folder, "stg_cvm_fre_posicao_acionaria").select("id_documento", "data_referencia")
    # of a document the earliest reference date counts, unknown dates aside
    first = filings.groupBy("id_documento").agg(F.min("data_referencia").alias("data_referencia"))
    cited = F.nullif(F.regexp_extract("fonte_documento", CITATION, 1), F.lit(""))
    return [
        ("cnpj", edges.select("id_vinculo", "data_referencia", F.col("cnpj").alias("chave")), companies),
        ("fonte_documento", edges.select("id_vinculo", "data_referencia", cited.alias("chave")), parent_intervals(first, "id_documento", "data_referencia")),
    ]


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name, refs, parents in _references(spark, folder):
        bad = orphan_references(refs, "chave", "data_referencia", parents).select(
            F.lit(name).alias("campo"), "id_vinculo", F.date_format("data_referencia", "yyyy-MM").alias("periodo"), "situacao"
        )
        out = bad if out is None else out.unionByName(bad)
    return out


def p7_relatorio(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans per field, month and reason."""
    return p7_found(spark, folder).groupBy("campo", "periodo", "situacao").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_resumo, p4_found, p4_caminhos, p4_descendentes, p5_found, p5_estado, p7_found, p7_relatorio)
}

_LAST = """
  rows_ as (select data, cnpj_basico, documento, qualificacao from (
      select *, row_number() over (partition by data, cnpj_basico, documento
                                   order by carregado_em desc nulls last, qualificacao desc nulls last) as rn
      from stg_rf_socio where data is not null and cnpj_basico is not null
        and documento is not null and not regexp_full_match(documento, '0+')) where rn = 1),
  days as (select data, row_number() over (order by data) as k from (
      select distinct data from stg_rf_socio where data is not null))"""

_P2 = f"""with {_LAST},
  r as (select rows_.*, k from rows_ join days using (data)),
  j as (select coalesce(n.k, o.k + 1) as k, coalesce(n.cnpj_basico, o.cnpj_basico) as cnpj_basico,
               coalesce(n.documento, o.documento) as documento,
               case when o.k is null then 'added' when n.k is null then 'removed'
                    when n.qualificacao is distinct from o.qualificacao then 'changed' end as mudanca
        from r n full join r o on n.k = o.k + 1 and n.cnpj_basico = o.cnpj_basico and n.documento = o.documento),
  found as (select strftime(days.data, '%Y-%m-%d') as data, cnpj_basico, documento, mudanca
            from j join days using (k) where k > 1 and mudanca is not null)
"""

_P4 = """with recursive e as (select cnpj as node, min(origem_id) as up from vinculos
      where acionista_controlador and cnpj is not null and origem_id is not null group by cnpj),
  walk(node, pos, depth, trail, looped) as (
      select node, up, 1, [node], up = node from e
      union all
      select w.node, e.up, w.depth + 1, list_append(w.trail, w.pos), list_contains(w.trail, e.up) or e.up = w.pos
      from walk w join e on e.node = w.pos where not w.looped),
  ended as (select w.* from walk w left join e on e.node = w.pos where e.node is null or w.looped)
"""

_P5 = f"""with {_LAST},
  d2 as (select data, row_number() over (order by data) as k from (select distinct data from stg_rf_empresa where data is not null)),
  emp as (select data, cnpj_basico, capital_social from (
      select *, row_number() over (partition by data, cnpj_basico
             order by carregado_em desc nulls last, try_cast(capital_social as decimal(30,2)) desc nulls last) as rn
      from stg_rf_empresa where data is not null and cnpj_basico is not null) where rn = 1),
  u as (select 'stg_rf_empresa' as tabela, cnpj_basico, '' as documento, k, cast(try_cast(capital_social as decimal(30,2)) as varchar) as v
        from emp join d2 using (data)
        union all select 'stg_rf_socio', cnpj_basico, documento, k, qualificacao from rows_ join days using (data)),
  m as (select *, case when lag(k) over w = k - 1 and lag(v) over w is not distinct from v then 0 else 1 end as turn
        from u window w as (partition by tabela, cnpj_basico, documento order by k)),
  g as (select *, sum(turn) over (partition by tabela, cnpj_basico, documento order by k) as grp from m),
  p as (select tabela, cnpj_basico, documento, min(k) as a, max(k) + 1 as b from g group by tabela, cnpj_basico, documento, grp),
  cal as (select 'stg_rf_socio' as tabela, data, k from days union all select 'stg_rf_empresa', data, k from d2)
select p.tabela, cnpj_basico, documento, strftime(c1.data, '%Y-%m-%d') as valido_de,
       coalesce(strftime(c2.data, '%Y-%m-%d'), '') as valido_ate
from p join cal c1 on c1.tabela = p.tabela and c1.k = a left join cal c2 on c2.tabela = p.tabela and c2.k = b"""

_P7 = """with docs as (select id_documento, min(data_referencia) as since from stg_cvm_fre_posicao_acionaria
      where id_documento is not null group by id_documento),
  emp as (select cnpj, case when count(motivo_entrada_date) = count(*) then min(motivo_entrada_date) end as since
          from empresas where cnpj is not null group by cnpj),
  refs as (select 'cnpj' as campo, id_vinculo, data_referencia, cnpj as chave from vinculos where cnpj is not null
      union all
      select 'fonte_documento', id_vinculo, data_referencia, regexp_extract(fonte_documento, 'id_documento=([0-9]+)$', 1)
      from vinculos where regexp_matches(fonte_documento, 'id_documento=[0-9]+$')),
  judged as (select r.campo, r.id_vinculo, strftime(r.data_referencia, '%Y-%m') as periodo,
      case when r.campo = 'cnpj' and e.cnpj is null then 'missing'
           when r.campo = 'fonte_documento' and d.id_documento is null then 'missing'
           when coalesce(e.since, d.since) > r.data_referencia then 'late' end as situacao
    from refs r left join emp e on r.campo = 'cnpj' and e.cnpj = r.chave
                left join docs d on r.campo = 'fonte_documento' and d.id_documento = r.chave),
  found as (select * from judged where situacao is not null)
"""

SQL = {
    "p2_found": _P2 + "select * from found",
    "p2_resumo": _P2 + "select data, mudanca, count(*) as n from found group by data, mudanca",
    "p4_found": _P4 + """select node as cnpj, case when looped then 'ciclo' else pos end as raiz,
        case when looped then -1 else depth end as profundidade from ended""",
    "p4_caminhos": _P4 + """, loop_ as (select node, pos, trail from ended where looped),
        named as (select node, list_min(list_slice(trail, list_position(trail, pos), len(trail))) as ciclo,
                  list_position(trail, pos) = 1 as no_ciclo from loop_)
        select e.node as cnpj, case when looped then null else e.pos end as raiz, case when looped then -1 else depth end as profundidade,
          case when looped then null else array_to_string(list_reverse(list_append(e.trail, e.pos)), ' > ') end as caminho, ciclo, no_ciclo
        from ended e left join named n on n.node = e.node""",
    "p4_descendentes": _P4 + """, good as (select * from ended where not looped)
        select t.x as ancestral, node as descendente, t.i as distancia
        from (select node, unnest(list_append(list_slice(trail, 2, len(trail)), pos)) as x,
                     unnest(range(1, len(trail) + 1)) as i from good) t""",
    "p5_found": _P5,
    "p5_estado": f"with {_LAST} select cnpj_basico, documento, qualificacao from rows_ join days using (data) where k = 7",
    "p7_found": _P7 + "select * from found",
    "p7_relatorio": _P7 + "select campo, periodo, situacao, count(*) as n from found group by campo, periodo, situacao",
}
