"""Queries of the pipeline's operators on the test tables, with their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .functions import documents as doc
from .functions import graph as gf
from .functions import hygiene as hy
from .functions import names as nm
from .operators import quality as q
from .operators.prefixes import fuzzy_block_join, prefix_join
from .operators.relational import cascade, distinct_counts, flag_exists, latest_group, ordered_concat, tagged_union, top_per_group, unique_keys
from .operators.walk import bounded_walk, edge_ends, innermost, simple_paths, without_incoming
from .plans import graph as gp
from .plans import marts, ownership, seeds, staging
from .queries_core import table
from .session import cut, reachable, shared_folder
from .sources.writers import write_table

CONFIG = Config()
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# --- SQL pieces shared by several texts ---------------------------------------
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
_FOLD = "translate(upper(" + _TRIM.format("coalesce({0}, '')") + "), 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ', 'AAAAAEEEEIIIIOOOOOUUUUCNY')"
_COMPANY = (
    "regexp_replace(regexp_replace(' ' || regexp_replace(translate(replace(upper(" + _TRIM.format("coalesce({0}, '')") + "), '&', 'E'), "
    "'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ', 'AAAAAEEEEIIIIOOOOOUUUUCNY'), '[^A-Z0-9]', ' ', 'g') || ' ', ' CIA ', ' COMPANHIA ', 'g'), '[^A-Z0-9]', '', 'g')"
)
_PERSON = r"regexp_replace(regexp_replace(replace(" + _FOLD + r", '-', ' '), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"
_CNPJ14 = "coalesce(regexp_full_match({0}, '[0-9]{{14}}') and not regexp_full_match({0}, '0+'), false)"
_CPF11 = "coalesce(regexp_full_match({0}, '[0-9]{{11}}'), false)"


# --- relational operators -----------------------------------------------------
@query("""select o.o_custkey, o.o_orderkey, o.o_orderdate from orders o
    join (select o_custkey, max(o_orderdate) as d from orders group by o_custkey) l on l.o_custkey = o.o_custkey and l.d = o.o_orderdate""")
def latest_doc(spark: SparkSession, folder: str) -> DataFrame:
    return latest_group(table(spark, folder, "orders"), "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey", "o_orderdate")


@query("""select l_orderkey, l_linenumber, l_returnflag from (select *, row_number() over (partition by l_orderkey
      order by case when l_returnflag = 'R' then 0 else 1 end, l_shipdate desc, l_linenumber, l_returnflag) as k from lineitem) where k = 1""")
def top1_total_order(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.when(F.col("l_returnflag") == "R", 0).otherwise(1), F.col("l_shipdate").desc(), F.col("l_linenumber"), F.col("l_returnflag")]
    return top_per_group(table(spark, folder, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("select n_regionkey, string_agg(n_name, '; ' order by n_name) as nomes from nation group by n_regionkey")
def ordered_concat_nations(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_concat(table(spark, folder, "nation"), ["n_regionkey"], F.col("n_name"), [F.col("n_name")], "nomes")


@query("""select razao_social, min(cnpj_basico) as cnpj_basico from (select distinct razao_social, cnpj_basico from stg_rf_empresa
    where data = date '2026-01-11') group by razao_social having count(*) = 1""")
def unique_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "stg_rf_empresa").where("data = date'2026-01-11'").select("razao_social", "cnpj_basico").distinct()
    return unique_keys(rows, "razao_social", "cnpj_basico")


@query("""select l_orderkey, l_linenumber, n_supp, n_part from lineitem join (
    select l_orderkey, count(distinct l_suppkey) as n_supp, count(distinct l_partkey) as n_part from lineitem group by l_orderkey) using (l_orderkey)""")
def distinct_window(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_counts(table(spark, folder, "lineitem"), ["l_orderkey"], {"n_supp": "l_suppkey", "n_part": "l_partkey"}).select("l_orderkey", "l_linenumber", "n_supp", "n_part")


@query("select distinct e.cnpj_basico from stg_rf_empresa e where not exists (select 1 from stg_rf_socio s where s.cnpj_basico = e.cnpj_basico)")
def left_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Registered companies that no partner list names."""
    partners = table(spark, folder, "stg_rf_socio").select("cnpj_basico").distinct()
    return table(spark, folder, "stg_rf_empresa").join(partners, "cnpj_basico", "left_anti").select("cnpj_basico").distinct()


@query("select c.c_custkey, exists (select 1 from orders o where o.o_custkey = c.c_custkey) as comprou from customer c")
def existence(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return flag_exists(table(spark, folder, "customer"), orders, ["c_custkey"], "comprou").select("c_custkey", "comprou")


@query("""select id_vinculo, coalesce(e.razao_social, f.nome_companhia, v.origem_nome) as nome from vinculos v
    left join (select cnpj, min(razao_social) as razao_social from empresas group by cnpj) e on e.cnpj = v.cnpj
    left join (select id_cnpj, min(nome_companhia) as nome_companhia from stg_cvm_fre_posicao_acionaria group by id_cnpj) f on f.id_cnpj = v.cnpj""")
def cascade_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "empresas").groupBy("cnpj").agg(F.min("razao_social").alias("r"))
    b = table(spark, folder, "stg_cvm_fre_posicao_acionaria").groupBy(F.col("id_cnpj").alias("cnpj")).agg(F.min("nome_companhia").alias("n"))
    return cascade(table(spark, folder, "vinculos"), [(a, ["cnpj"], "r"), (b, ["cnpj"], "n")], "nome", F.col("origem_nome")).select("id_vinculo", "nome")


@query("""select 'cliente' as origem, c_nationkey as pais, count(*) as n from customer group by c_nationkey
    union all select 'fornecedor', s_nationkey, count(*) from supplier group by s_nationkey""")
def union_all_tagged(spark: SparkSession, folder: str) -> DataFrame:
    parts = {"cliente": table(spark, folder, "customer").select(F.col("c_nationkey").alias("pais")), "fornecedor": table(spark, folder, "supplier").select(F.col("s_nationkey").alias("pais"))}
    return tagged_union(parts).groupBy("origem", "pais").agg(F.count(F.lit(1)).alias("n"))


# --- expressions --------------------------------------------------------------
@query(f"""select distinct nome, {_COMPANY.format('nome')} as chave_empresa, {_PERSON.format('nome')} as chave_pessoa, {_FOLD.format('nome')} as dobrado,
    len(string_split({_PERSON.format('nome')}, ' ')) as n_tok, string_split({_PERSON.format('nome')}, ' ')[1] as primeiro,
    string_split({_PERSON.format('nome')}, ' ')[-1] as ultimo, regexp_replace({_COMPANY.format('nome')}, '(SA|LTDA|EIRELI)$', '') as sem_sufixo,
    regexp_replace(nome, ' - .*', '') as antes, regexp_extract(nome, '\\(([^)]+)\\)', 1) as entre from stg_rf_socio""")
def name_keys(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "stg_rf_socio").select("nome").distinct()
    person = nm.person_key("nome")
    return n.select(
        "nome", nm.company_key("nome").alias("chave_empresa"), person.alias("chave_pessoa"), nm.fold_upper("nome").alias("dobrado"), nm.token_count(person).alias("n_tok"),
        nm.first_token(person).alias("primeiro"), nm.last_token(person).alias("ultimo"), nm.strip_legal_suffix(nm.company_key("nome")).alias("sem_sufixo"),
        nm.text_before_dash("nome").alias("antes"), nm.first_parenthetical("nome").alias("entre"),
    )


@query(f"""select id_vinculo, {_CNPJ14.format('origem_documento')} as cnpj_inteiro, {_CPF11.format('origem_documento')} as cpf_inteiro,
    case when {_CPF11.format('origem_documento')} then substr(origem_documento, 4, 6)
         when length({_DIGITS.format('origem_documento')}) = 6 then {_DIGITS.format('origem_documento')} end as mask6,
    case when {_CPF11.format('origem_documento')} then 'p-' || substr(sha256(origem_documento), 1, 8) end as pessoa,
    coalesce(regexp_full_match({_DIGITS.format('origem_documento')}, '0+'), false) as vazio,
    case when length({_DIGITS.format('origem_documento')}) between 1 and 14 and not regexp_full_match({_DIGITS.format('origem_documento')}, '0+')
         then lpad({_DIGITS.format('origem_documento')}, 14, '0') end as cnpj14,
    case when length({_DIGITS.format('cnpj')}) = 14 then left({_DIGITS.format('cnpj')}, 8) end as raiz,
    case when length({_DIGITS.format('origem_documento')}) in (14, 11, 8) then {_DIGITS.format('origem_documento')} else nullif({_TRIM.format('origem_documento')}, '') end as documento
    from vinculos""")
def doc_guards(spark: SparkSession, folder: str) -> DataFrame:
    d = "origem_documento"
    return table(spark, folder, "vinculos").select(
        "id_vinculo", doc.is_cnpj14(d).alias("cnpj_inteiro"), doc.is_cpf11(d).alias("cpf_inteiro"), doc.cpf_mask6(d).alias("mask6"),
        F.when(doc.is_cpf11(d), doc.person_id_from_cpf(d)).alias("pessoa"), doc.is_placeholder_cnpj(d).alias("vazio"), doc.cnpj14(d).alias("cnpj14"),
        doc.prefix8_from_cnpj14("cnpj").alias("raiz"), doc.identifying_document(d).alias("documento"),
    )


@query(r"""with t as (select id_documento || '|' || id_acionista || '|' || cast(versao as varchar) as k, data_composicao_capital_social as d,
      cast(quantidade_total_acao_circulacao as varchar) as q, replace(cast(cast(round(quantidade_total_acao_circulacao / 100.0, 2) as decimal(20,2)) as varchar), '.', ',') as br
      from stg_cvm_fre_posicao_acionaria)
    select k, coalesce(try_cast(case when regexp_full_match(d, '\d{4}-\d{1,2}-\d{1,2}.*') then d end as date), cast(try_strptime(d, '%d/%m/%Y') as date)) as dia,
      strftime(coalesce(try_cast(case when regexp_full_match(d, '\d{4}-\d{1,2}-\d{1,2}.*') then d end as date), cast(try_strptime(d, '%d/%m/%Y') as date)), '%Y%m') as mes,
      try_cast(q as bigint) as inteiro, try_cast(q as double) as real, try_cast(replace(br, ',', '.') as decimal(38,9)) as dinheiro,
      case when length(regexp_replace(q, '[^0-9]', '', 'g')) > 0 then lpad(regexp_replace(q, '[^0-9]', '', 'g'), 4, '0') end as codigo from t""")
def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "stg_cvm_fre_posicao_acionaria")
    q_ = F.col("quantidade_total_acao_circulacao")
    br = F.replace(F.round(q_ / 100, 2).cast("decimal(20,2)").cast("string"), F.lit("."), F.lit(","))
    day = hy.to_date("data_composicao_capital_social")
    return t.select(
        F.concat_ws("|", "id_documento", "id_acionista", F.col("versao").cast("string")).alias("k"), day.alias("dia"), hy.year_month(day).alias("mes"), hy.to_int64(q_).alias("inteiro"),
        hy.to_float64(q_).alias("real"), hy.parse_br_numeric(br).alias("dinheiro"), hy.padded_code(q_, 4).alias("codigo"),
    )


@query("""select id_vinculo, case papel when 'acionista_controlador' then 'CONTROLADOR' when 'acionista' then 'ACIONISTA' when 'socio' then 'SOCIO' else 'VINCULO' end as rel,
    case origem_tipo when 'pessoa' then 'Pessoa' when 'empresa' then 'Empresa' when 'estado' then 'Estado' else 'Parada' end as rotulo from vinculos""")
def graph_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "vinculos").select("id_vinculo", gf.relation("papel").alias("rel"), gf.node_label("origem_tipo").alias("rotulo"))


@query("""select id_vinculo, case papel when 'acionista_controlador' then 'controlador' when 'acionista' then 'acionista' when 'socio' then 'sócio' else papel end
      || ' · ' || case when fonte = 'fre' then 'FRE' else 'QSA' end || case
      when percentual_on is not null and not isnan(percentual_on) then ' · ' || printf('%g', percentual_on) || '% ON'
      when percentual_total is not null and not isnan(percentual_total) then ' · ' || printf('%g', percentual_total) || '% total'
      when fonte = 'qsa' then ' · sem %' else '' end as nome from vinculos""")
def edge_names(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "vinculos").withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("percentual_on", "percentual_total")})
    return v.select("id_vinculo", gf.edge_name("papel", "fonte", "percentual_on", "percentual_total").alias("nome"))


# --- joins --------------------------------------------------------------------
@query(f"""with k as (select distinct {_COMPANY.format('nome')} as chave from stg_valor_ranking),
    s as (select distinct razao_social as rf, {_COMPANY.format('razao_social')} as rf_chave from stg_rf_empresa where data = date '2026-01-11')
    select chave, rf from k join s on starts_with(rf_chave, chave) or starts_with(chave, rf_chave)""")
def prefix_pairs(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "stg_valor_ranking").select(nm.company_key("nome").alias("chave")).distinct()
    names = table(spark, folder, "stg_rf_empresa").where("data = date'2026-01-11'").select(F.col("razao_social").alias("rf")).distinct().withColumn("rf_chave", nm.company_key("rf"))
    return prefix_join(keys, names, "chave", "rf_chave").select("chave", "rf").distinct()


@query(f"""with p as (select distinct {_PERSON.format('nome')} as k from stg_rf_socio where tipo = '2'),
    t as (select k, string_split(k, ' ') as w from p)
    select a.k as a, b.k as b from t a join t b on a.w[1] = b.w[1] and a.w[-1] = b.w[-1] and a.k != b.k
    where (levenshtein(a.k, b.k) <= 2 and len(a.w) = len(b.w)) or (least(len(a.w), len(b.w)) >= 3 and (list_has_all(a.w, b.w) or list_has_all(b.w, a.w)))""")
def fuzzy_block(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "stg_rf_socio").where("tipo = '2'").select(nm.person_key("nome").alias("a")).distinct()
    return fuzzy_block_join(p, p.withColumnRenamed("a", "b"), "a", "b")


# --- graph walks --------------------------------------------------------------
_STEPS = "steps as (select distinct cnpj as here, origem_id as there, fonte from vinculos where origem_tipo = 'empresa' and cnpj is not null and origem_id is not null and origem_id != cnpj)"


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "vinculos").where("origem_tipo = 'empresa'").select(F.col("cnpj").alias("here"), F.col("origem_id").alias("there"), F.col("fonte").alias("source"))


@query(f"""with recursive {_STEPS}, seeds as (select cnpj from empresas where motivo_entrada_categoria = 'semente'),
    w(cnpj, profundidade, cnpj_origem, fonte_chegada) as (
      select cnpj, 0, cast(null as varchar), 'semente' from seeds
      union select there, profundidade + 1, here, fonte from w join steps on here = w.cnpj where profundidade < 8)
    select cnpj, profundidade, cnpj_origem, fonte_chegada from (select *, row_number() over (partition by cnpj
      order by profundidade, cnpj_origem, fonte_chegada) as k from w) where k = 1""")
def walk_bounded(spark: SparkSession, folder: str) -> DataFrame:
    seeds_ = table(spark, folder, "empresas").where("motivo_entrada_categoria = 'semente'").select(F.col("cnpj").alias("node"))
    out = bounded_walk(seeds_, _steps(spark, folder))
    return out.select(F.col("node").alias("cnpj"), F.col("depth").alias("profundidade"), F.col("came_from").alias("cnpj_origem"), F.col("source").alias("fonte_chegada"))


@query("""with recursive e as (select distinct origem_id as here, cnpj as there from vinculos where acionista_controlador and origem_id is not null and cnpj is not null),
    t as (select distinct cnpj from stg_x where false), p(start, target, hops, used) as (
      select here, there, 1, [here || '>' || there] from e where there in (select cnpj from empresas where motivo_entrada_categoria = 'semente')
      union all select e.here, p.target, p.hops + 1, list_append(p.used, e.here || '>' || e.there) from p join e on e.there = p.start
      where p.hops < 6 and not list_contains(p.used, e.here || '>' || e.there))
    select start as inicio, target as fim, hops as passos from p""".replace("t as (select distinct cnpj from stg_x where false), ", ""))
def var_length_path(spark: SparkSession, folder: str) -> DataFrame:
    """Every control path of up to six steps that ends at a seed company."""
    control = table(spark, folder, "vinculos").where("acionista_controlador").select(F.col("origem_id").alias("here"), F.col("cnpj").alias("there"))
    targets = table(spark, folder, "empresas").where("motivo_entrada_categoria = 'semente' and cnpj is not null").select(F.col("cnpj").alias("node")).distinct()
    out = simple_paths(control, targets, 6)
    return out.select(F.col("start").alias("inicio"), F.col("target").alias("fim"), F.col("hops").alias("passos"))


@query(f"""with {_STEPS}, vias as (select distinct here as k, there as via from steps)
    select k, via from vias v where not exists (select 1 from vias o join steps d on d.there = o.via and d.here = v.via where o.k = v.k and o.via != v.via)""")
def innermost_vehicle(spark: SparkSession, folder: str) -> DataFrame:
    s = _steps(spark, folder).where("here != there")
    owns = s.select(F.col("there").alias("owner"), F.col("here").alias("owned"))
    return innermost(s.select(F.col("here").alias("k"), F.col("there").alias("via")), owns, ["k"])


@query(f"""with {_STEPS} select x as node from (select here as x from steps union select there from steps) where x not in (select cnpj from empresas where cnpj is not null)""")
def ends_without_node(spark: SparkSession, folder: str) -> DataFrame:
    return edge_ends(_steps(spark, folder).where("here != there"), table(spark, folder, "empresas").select(F.col("cnpj").alias("node")))


@query("select cnpj as node from empresas e where not exists (select 1 from vinculos v where v.cnpj = e.cnpj)")
def zero_in_degree(spark: SparkSession, folder: str) -> DataFrame:
    edges = table(spark, folder, "vinculos").select(F.col("origem_id").alias("here"), F.col("cnpj").alias("there"))
    return without_incoming(table(spark, folder, "empresas").select(F.col("cnpj").alias("node")), edges)


# --- the pipeline ---------------------------------------------------------------
#: The test tables have no establishments. Each registered root gets up to three offices by its last digit: order,
#: condition for being there, for being called head office and for being active.
_OFFICES = (("0001", "true", "d < 7", "d > 1"), ("0002", "d != 4", "d >= 5 or d = 0", "d != 6"), ("0003", "d != 9 and d != 4", "d = 8", "true"))


def establishments(spark: SparkSession, folder: str) -> DataFrame:
    """Offices of all registered roots: one to three each, of which none, one or two claim to be the head office, some of them closed.

    Roots that end in 44 have none.
    """
    roots = table(spark, folder, "stg_rf_empresa").select("data", "cnpj_basico").distinct().where("cnpj_basico not like '%44'").withColumn("d", F.expr("cast(right(cnpj_basico, 1) as int)"))
    offices = F.array(*[
        F.when(F.expr(there), F.struct(F.lit(order).alias("cnpj_ordem"), F.when(F.expr(head), "1").otherwise("2").alias("identificador_matriz_filial"), F.when(F.expr(active), "02").otherwise("08").alias("situacao_cadastral")))
        for order, there, head, active in _OFFICES
    ])
    each = roots.select("data", "cnpj_basico", F.explode(offices).alias("o")).where("o is not null").select("data", "cnpj_basico", "o.*")
    return each.withColumn("cnpj", F.concat("cnpj_basico", "cnpj_ordem", F.lit("00")))


def _current(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Of repeated deliveries of a row the last loaded."""
    return top_per_group(df, keys, [F.col("carregado_em").desc(), *[F.col(v) for v in values]])


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    now = table(spark, folder, "stg_rf_empresa").where("data = date'2026-01-11'")
    return _current(now, ["data", "cnpj_basico"], ["razao_social", "natureza_juridica", "ente_federativo", "capital_social"])


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    fre, partners = table(spark, folder, "stg_cvm_fre_posicao_acionaria"), table(spark, folder, "stg_rf_socio")
    return ownership.ownership_edges(fre, partners, _registry(spark, folder), establishments(spark, folder), CONFIG)


_CURRENT = """emp as (select * from (select *, row_number() over (partition by data, cnpj_basico order by carregado_em desc,
        razao_social nulls first, natureza_juridica nulls first, ente_federativo nulls first, capital_social nulls first) as rn
      from stg_rf_empresa where data = date '2026-01-11') where rn = 1),
  roots as (select distinct cnpj_basico, cast(right(cnpj_basico, 1) as int) as d from stg_rf_empresa where data = date '2026-01-11' and cnpj_basico not like '%44'),
  offices as (""" + " union all ".join(
    f"select cnpj_basico, '{order}' as ordem, case when {head} then 1 else 2 end as mf, case when {active} then '02' else '08' end as sit from roots where {there}" for order, there, head, active in _OFFICES
) + """),
  est as (select cnpj_basico, cnpj_basico || ordem || '00' as cnpj from (select *, row_number() over (partition by cnpj_basico order by mf, sit != '02', ordem) as k from offices) where k = 1)"""

_CODES = ", ".join(f"'{c}'" for c in ownership.OWNERSHIP)
_EDGES = f"""{_CURRENT},
  last_doc as (select id_cnpj, max(id_documento) as id_documento from stg_cvm_fre_posicao_acionaria where id_cnpj is not null and id_documento is not null group by id_cnpj),
  u as (select 'fre' as fonte, f.id_cnpj as cnpj, left(f.id_cnpj, 8) as cnpj_basico, f.id_documento, nome_acionista as origem_nome, documento_acionista as origem_documento,
      tipo_pessoa_acionista as pessoa, cast(null as varchar) as qualificacao, cast(null as varchar) as qsa, indicador_acionista_controlador as ctrl,
      indicador_participante_acordo_acionistas as acordo, proporcao_acao_ordinaria_circulacao as percentual_on, proporcao_total_acao_circulacao as percentual_total, data_referencia,
      'fre_cia_aberta_posicao_acionaria_2026 id_documento=' || f.id_documento as fonte_documento, true as info, nome_acionista_relacionado as via, documento_acionista_relacionado as via_doc
    from stg_cvm_fre_posicao_acionaria f join last_doc l on l.id_cnpj = f.id_cnpj and l.id_documento = f.id_documento where nome_acionista is not null
    union all
    select 'qsa', est.cnpj, s.cnpj_basico, null, nome, documento, null, qualificacao, tipo, null, null, null, null, data,
      'rf.socios partição ' || cast(data as varchar) || ' cnpj_basico=' || s.cnpj_basico, false, null, null
    from stg_rf_socio s join est on est.cnpj_basico = s.cnpj_basico where data = date '2026-01-11' and qualificacao in ({_CODES}) and nome is not null),
  uk as (select {_COMPANY.format('razao_social')} as chave, min(cnpj_basico) as cnpj_basico from emp where razao_social is not null group by 1 having count(*) = 1),
  mat as (select uk.chave, est.cnpj from uk join est using (cnpj_basico)),
  k as (select u.*, {_COMPANY.format('origem_nome')} as chave_nome,
      case when {_CNPJ14.format('origem_documento')} then origem_documento else m1.cnpj end as owner,
      case when {_CNPJ14.format('via_doc')} then via_doc else m2.cnpj end as via_cnpj
    from u left join mat m1 on length(coalesce(origem_documento, '')) != 14 and m1.chave = {_COMPANY.format('origem_nome')}
           left join mat m2 on via is not null and length(coalesce(via_doc, '')) != 14 and m2.chave = {_COMPANY.format('via')}),
  n as (select k.*, natureza_juridica as nat, ente_federativo as ente, {_FOLD.format('origem_nome')} as nd, {_FOLD.format('pessoa')} as td
    from k left join emp on {_CNPJ14.format('owner')} and emp.cnpj_basico = left(owner, 8)),
  ty as (select *, case when nd = 'OUTROS' then 'outros' when nd like '%TESOURARIA%' then 'tesouraria' when nat in ('2011', '2038') then 'empresa'
      when nat like '1%' or ente is not null or chave_nome in ('UNIAO', 'UNIAOFEDERAL', 'TESOURONACIONAL', 'FAZENDANACIONAL') then 'estado'
      when td like '%FISICA%' or td = 'PF' or qsa = '2' or length(origem_documento) = 11 then 'pessoa'
      when coalesce(regexp_full_match({_DIGITS.format('origem_documento')}, '0+'), false) then 'estrangeiro' when qsa = '3' and owner is null then 'estrangeiro'
      when {_CNPJ14.format('owner')} then 'empresa' when td like '%JURIDICA%' or td = 'PJ' or qsa = '1' then 'nao_resolvido' when qsa = '3' then 'estrangeiro' else 'nao_resolvido' end as origem_tipo
    from n),
  base as (select origem_tipo, case when origem_tipo = 'pessoa' then case when {_CPF11.format('origem_documento')} then 'p-' || substr(sha256(origem_documento), 1, 8)
        else 'nome:' || {_PERSON.format('origem_nome')} || '@' || cnpj end
      when origem_tipo = 'empresa' then owner when origem_tipo = 'estado' then coalesce(owner, 'estado:' || chave_nome)
      when origem_tipo in ('outros', 'tesouraria') then origem_tipo || ':' || chave_nome || '@' || cnpj else origem_tipo || ':' || chave_nome end as origem_id,
      origem_nome, origem_documento, cnpj, case when fonte = 'qsa' then 'socio' when ctrl = 'S' then 'acionista_controlador' else 'acionista' end as papel, fonte,
      case when fonte = 'qsa' then null when ctrl = 'S' then true when ctrl = 'N' then false end as acionista_controlador,
      percentual_on, percentual_total, qualificacao, data_referencia, fonte_documento, id_documento, via_cnpj from ty),
  pt as (select *, {_PERSON.format('origem_nome')} as ck, case when {_CPF11.format('origem_documento')} then substr(origem_documento, 4, 6)
        when length({_DIGITS.format('origem_documento')}) = 6 then {_DIGITS.format('origem_documento')} end as m6,
      case when {_CPF11.format('origem_documento')} then origem_documento end as cpf from base where origem_tipo = 'pessoa'),
  pf as (select *, string_split(ck, ' ') as w, case when cpf is not null then 'p-' || substr(sha256(cpf), 1, 8) end as pid from pt),
  bk as (select ck, count(cpf) as ncpf, count(distinct m6) as nm from pf group by ck),
  l1 as (select ck, m6, min(pid) as pid from pf where cpf is not null group by 1, 2 having count(distinct cpf) = 1),
  l2 as (select ck, min(pid) as pid from pf where cpf is not null group by 1 having count(distinct cpf) = 1),
  l3 as (select w[1] as p, w[-1] as z, m6, min(pid) as pid from pf where cpf is not null group by 1, 2, 3 having count(distinct cpf) = 1),
  an as (select distinct ck, w, pid from pf where cpf is not null),
  na as (select distinct pf.ck, pf.w from pf join bk using (ck) where ncpf = 0),
  l4 as (select na.ck, min(an.pid) as pid from na join an on na.w[1] = an.w[1] and na.w[-1] = an.w[-1] and na.ck != an.ck
      where (levenshtein(na.ck, an.ck) <= 2 and len(na.w) = len(an.w)) or (least(len(na.w), len(an.w)) >= 3 and (list_has_all(an.w, na.w) or list_has_all(na.w, an.w)))
      group by 1 having count(distinct an.pid) = 1),
  pr as (select pf.* replace (coalesce(pf.pid, l1.pid, l2.pid, l3.pid, l4.pid, case when nm = 1 or len(w) >= 3 then 'nome:' || ck else origem_id end) as origem_id)
    from pf join bk using (ck) left join l1 on l1.ck = pf.ck and l1.m6 = pf.m6 left join l2 on l2.ck = pf.ck
    left join l3 on l3.p = w[1] and l3.z = w[-1] and l3.m6 = pf.m6 left join l4 on l4.ck = pf.ck),
  edges as (select origem_tipo, origem_id, origem_nome, origem_documento, cnpj, papel, fonte, acionista_controlador, percentual_on, percentual_total, qualificacao,
      data_referencia, fonte_documento, id_documento, via_cnpj from pr
    union all select origem_tipo, origem_id, origem_nome, origem_documento, cnpj, papel, fonte, acionista_controlador, percentual_on, percentual_total, qualificacao,
      data_referencia, fonte_documento, id_documento, via_cnpj from base where origem_tipo != 'pessoa')
"""
_EDGE_COLUMNS = "origem_tipo, origem_id, origem_nome, origem_documento, cnpj, papel, fonte, acionista_controlador, percentual_on, percentual_total, qualificacao, data_referencia, fonte_documento, id_documento, via_cnpj"


@query(f"with {_EDGES} select {_EDGE_COLUMNS} from edges")
def ownership_edges(spark: SparkSession, folder: str) -> DataFrame:
    """All edges from filings and partner lists, owners classified and persons resolved."""
    return _edges(spark, folder).select(*_EDGE_COLUMNS.split(", "))


@query(f"with {_EDGES} select origem_tipo, fonte, count(*) as n, count(distinct origem_id) as donos from edges group by origem_tipo, fonte")
def owner_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return _edges(spark, folder).groupBy("origem_tipo", "fonte").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("origem_id").alias("donos"))


#: Sectors whose entries stand for the second and the third list, which the test tables lack.
_SECOND, _THIRD = "Alimentos", "Indústria Diversa"


def _seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Seeds from three lists, the registry and six registers in order of trust."""
    ranking, listed = table(spark, folder, "stg_valor_ranking"), table(spark, folder, "stg_cvm_cia_aberta")
    filed, edges = table(spark, folder, "stg_cvm_fre_posicao_acionaria"), table(spark, folder, "vinculos")
    sector = F.coalesce("setor", F.lit(""))
    lists = [ranking.where(~sector.isin(_SECOND, _THIRD)), ranking.where(sector == _SECOND), ranking.where(sector == _THIRD)]
    company = filed.where(F.length("documento_acionista") == 14)
    registers = [
        (listed, "razao_social", "situacao"), (listed, "nome_comercial", "situacao"), (filed.select("id_cnpj", "nome_companhia").distinct(), "nome_companhia", None),
        (table(spark, folder, "empresas").select(F.col("cnpj").alias("id_cnpj"), "razao_social"), "razao_social", None),
        (edges.where("origem_tipo = 'empresa'").select(F.col("origem_id").alias("id_cnpj"), "origem_nome").distinct(), "origem_nome", None),
        (company.select(F.col("documento_acionista").alias("id_cnpj"), "nome_acionista").distinct(), "nome_acionista", None),
    ]
    return seeds.seed_companies(*lists, _registry(spark, folder), establishments(spark, folder), registers, CONFIG)


_SEEDS = f"""{_CURRENT},
  lst0 as (select *, case setor when '{_SECOND}' then 2 when '{_THIRD}' then 3 else 1 end as lista from stg_valor_ranking),
  lst as (select {_COMPANY.format('coalesce(razao_social, nome)')} as cn, nome, coalesce(razao_social, nome) as razao, posicao, lista,
    'Valor 1000 2025, ' || case lista when 1 then 'ranking industrial' when 2 then 'bancos' else 'seguradoras' end || ', posição ' || posicao as cit from lst0),
  esc as (select * from (select *, row_number() over (partition by cn order by lista, posicao) as k from lst) where k = 1),
  mot as (select cn, string_agg(cit, '; ' order by lista, posicao) as m from lst group by cn),
  ks as (select cn, cn as chave, 1 as pr from esc union all select cn, {_COMPANY.format("regexp_replace(razao, ' - .*', '')")}, 2 from esc where razao like '% - %'
    union all select cn, {_COMPANY.format("regexp_extract(razao, '\\(([^)]+)\\)', 1)")}, 3 from esc where razao like '%(%'),
  rf as (select {_COMPANY.format('razao_social')} as chave, cnpj_basico, razao_social, capital_social from emp where razao_social is not null),
  ex as (select * from (select ks.cn, rf.*, row_number() over (partition by cn order by pr, capital_social desc nulls last, cnpj_basico) as k from ks join rf using (chave) where chave != '') where k = 1),
  miss as (select ks.* from ks where cn not in (select cn from ex)),
  pk as (select cn, chave, pr from miss where length(chave) >= 8 union all
    select cn, regexp_replace(chave, '(SA|LTDA|EIRELI)$', ''), 4 from miss where length(regexp_replace(chave, '(SA|LTDA|EIRELI)$', '')) >= 5),
  px as (select * from (select pk.cn, rf.*, row_number() over (partition by cn order by pr, capital_social desc nulls last, cnpj_basico) as k
    from pk join rf on starts_with(rf.chave, pk.chave) or starts_with(pk.chave, rf.chave)) where k = 1),
  un as (select cn, cnpj_basico, razao_social, capital_social from ex union all select cn, cnpj_basico, razao_social, capital_social from px),
  cad as (select {_COMPANY.format('razao_social')} as chave, id_cnpj, 1 as o, case when situacao = 'ATIVO' then 0 else 1 end as si from stg_cvm_cia_aberta where id_cnpj is not null and razao_social is not null
    union all select {_COMPANY.format('nome_comercial')}, id_cnpj, 2, case when situacao = 'ATIVO' then 0 else 1 end from stg_cvm_cia_aberta where id_cnpj is not null and nome_comercial is not null
    union all select {_COMPANY.format('nome_companhia')}, id_cnpj, 3, 0 from stg_cvm_fre_posicao_acionaria where id_cnpj is not null and nome_companhia is not null
    union all select {_COMPANY.format('razao_social')}, cnpj, 4, 0 from empresas where cnpj is not null and razao_social is not null
    union all select {_COMPANY.format('origem_nome')}, origem_id, 5, 0 from vinculos where origem_tipo = 'empresa' and origem_id is not null and origem_nome is not null
    union all select {_COMPANY.format('nome_acionista')}, documento_acionista, 6, 0 from stg_cvm_fre_posicao_acionaria where length(documento_acionista) = 14 and nome_acionista is not null),
  cd as (select * from (select ks.cn, id_cnpj, row_number() over (partition by cn order by pr, si, o, id_cnpj) as k from ks join cad using (chave) where chave != '') where k = 1),
  res as (select coalesce(est.cnpj, cd.id_cnpj) as cnpj, coalesce(un.razao_social, esc.razao) as razao, un.capital_social, un.cnpj_basico, m
    from esc join mot using (cn) left join un using (cn) left join est on est.cnpj_basico = un.cnpj_basico left join cd using (cn)),
  sem as (select res.cnpj, min(razao) as razao_social, max(coalesce(res.capital_social, rf.capital_social)) as capital_social, 'semente' as motivo_entrada_categoria
    from res left join rf on res.cnpj_basico is null and rf.cnpj_basico = left(res.cnpj, 8) where res.cnpj is not null group by res.cnpj),
  sed as (select sem.*, d as motivo_entrada_descricao, date '2025-09-16' as motivo_entrada_date from sem join (select cnpj, string_agg(m, '; ' order by m) as d from res where cnpj is not null group by cnpj) using (cnpj))
"""


@query(f"with {_SEEDS} select * from sed")
def seed_companies(spark: SparkSession, folder: str) -> DataFrame:
    return _seeds(spark, folder)


def _as_of(spark: SparkSession, folder: str) -> str:
    """A digest of the names, lengths and times of the tables' files: another one as soon as any of them is written again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files, seen = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True), []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def _layer(spark: SparkSession, folder: str, name: str, made) -> DataFrame:
    """The intermediate table ``name`` of ``folder``, written once per session and state of the tables and read from then on.

    It lies beside the session's checkpoints in the shared folder. A table counts as written once its ``_SUCCESS`` is there.
    """
    root = f"{shared_folder(reachable(spark))}/camada/{_as_of(spark, folder)}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/intermediate/{name}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        write_table(made(), root, "intermediate", name)
    return spark.read.parquet(f"{root}/intermediate/{name}")


def _marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    edges = _layer(spark, folder, "edges", lambda: _edges(spark, folder))
    found = _layer(spark, folder, "seeds", lambda: _seeds(spark, folder))
    walk = _layer(spark, folder, "walk", lambda: marts.walk_up(edges, found, CONFIG))
    served = _layer(spark, folder, "vinculos", lambda: marts.edges_mart(edges, walk))
    return {"edges": edges, "seeds": found, "walk": walk, "vinculos": served, "empresas": marts.companies_mart(found, edges, walk, _registry(spark, folder), CONFIG), "pessoas": marts.persons_mart(served, edges)}


_WALK = f"""{_EDGES}, {_SEEDS.replace(_CURRENT + ',', '', 1)},
  dona as (select distinct origem_id as owner, cnpj as owned, fonte from edges where origem_tipo = 'empresa' and {_CNPJ14.format('origem_id')} and origem_id != cnpj),
  step as (select owned as here, owner as there, fonte from dona union select cnpj, via_cnpj, 'via' from edges where origem_tipo = 'pessoa' and {_CNPJ14.format('via_cnpj')} and via_cnpj != cnpj),
  wk(cnpj, profundidade, cnpj_origem, fonte_chegada) as (select cnpj, 0, cast(null as varchar), 'semente' from sed
    union select there, profundidade + 1, here, fonte from wk join step on here = wk.cnpj where profundidade < 8),
  walk as (select * exclude k from (select *, row_number() over (partition by cnpj order by profundidade, cnpj_origem, fonte_chegada) as k from wk) where k = 1)
"""
_SERVED = f"""{_WALK}, vis as (select e.*, coalesce({_CNPJ14.format('via_cnpj')}, false) as tv from edges e where cnpj in (select cnpj from walk)),
  pv as (select distinct origem_id, cnpj, via_cnpj from vis where origem_tipo = 'pessoa' and tv),
  vi as (select * from pv where not exists (select 1 from pv o join dona d on d.owner = o.via_cnpj and d.owned = pv.via_cnpj where o.origem_id = pv.origem_id and o.cnpj = pv.cnpj and o.via_cnpj != pv.via_cnpj)),
  livro as (select vis.* from vis left join (select distinct owner, owned from dona) d on d.owner = vis.origem_id and d.owned = vis.via_cnpj and tv
    where not (origem_tipo = 'pessoa' and tv) and not (origem_tipo = 'empresa' and tv and d.owner is not null)),
  inv as (select vis.* replace (vis.via_cnpj as cnpj, cast(null as double) as percentual_on, cast(null as double) as percentual_total) from vis join vi using (origem_id, cnpj, via_cnpj)
    where origem_tipo = 'pessoa' and tv and not exists (select 1 from livro l where l.origem_tipo = 'pessoa' and l.origem_id = vis.origem_id and l.cnpj = vis.via_cnpj)),
  serv as (select * exclude k from (select *, row_number() over (partition by origem_id, cnpj, fonte order by percentual_on is null, fonte_documento nulls first, percentual_on desc nulls last,
      papel nulls first, origem_nome nulls first, origem_documento nulls first, qualificacao nulls first) as k from (select * from livro union all select * from inv)) where k = 1)
"""


@query(f"with recursive {_WALK} select cnpj, profundidade, cnpj_origem, fonte_chegada from walk")
def walk_up(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(spark, folder)["walk"]


@query(f"with recursive {_SERVED} select origem_tipo, origem_id, origem_nome, origem_documento, cnpj, papel, fonte, percentual_on, qualificacao, fonte_documento from serv")
def mart_vinculos(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(spark, folder)["vinculos"].select("origem_tipo", "origem_id", "origem_nome", "origem_documento", "cnpj", "papel", "fonte", "percentual_on", "qualificacao", "fonte_documento")


@query(f"""with recursive {_SERVED}, full_ as (select origem_id, min(origem_documento) as cpf from edges where origem_tipo = 'pessoa' and {_CPF11.format('origem_documento')} group by origem_id)
    select origem_id as pessoa_id, origem_nome as nome, coalesce(case when {_CPF11.format('origem_documento')} then origem_documento end, cpf) as cpf from (
      select s.*, row_number() over (partition by origem_id order by not {_CPF11.format('origem_documento')}, case when fonte = 'fre' then 0 else 1 end, origem_nome nulls first, origem_documento nulls first) as k
      from serv s where origem_tipo = 'pessoa') left join full_ using (origem_id) where k = 1""")
def mart_pessoas(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(spark, folder)["pessoas"]


@query(f"""with recursive {_WALK}, ab as (select cnpj from walk where profundidade > 0),
    own as (select origem_id as cnpj, cnpj as iss, fonte, id_documento, data_referencia, origem_nome from edges where origem_tipo = 'empresa' and origem_id in (select cnpj from ab)),
    ci as (select cnpj, string_agg(case when fonte = 'fre' then 'FRE id_documento ' || coalesce(id_documento, '') || ' da companhia ' || iss else 'QSA RF partição 2026-01-11 da empresa ' || iss end, '; ' order by iss, fonte) as d,
      min(data_referencia) as q from own group by cnpj),
    vc as (select via_cnpj as cnpj, string_agg('FRE Acionista_Relacionado da companhia ' || cnpj, '; ' order by cnpj) as d, min(data_referencia) as q
      from edges where origem_tipo = 'pessoa' and {_CNPJ14.format('via_cnpj')} and via_cnpj in (select cnpj from ab) group by via_cnpj),
    nn as (select * from (select cnpj, origem_nome, row_number() over (partition by cnpj order by fonte, origem_nome nulls first) as k from own) where k = 1)
    select cnpj, razao_social, capital_social, motivo_entrada_categoria, motivo_entrada_descricao, motivo_entrada_date from sed
    union all select ab.cnpj, coalesce(emp.razao_social, nn.origem_nome), emp.capital_social, 'subida', coalesce(ci.d, vc.d), coalesce(ci.q, vc.q)
    from ab left join emp on emp.cnpj_basico = left(ab.cnpj, 8) left join ci on ci.cnpj = ab.cnpj left join vc on vc.cnpj = ab.cnpj left join nn on nn.cnpj = ab.cnpj
    where {_CNPJ14.format('ab.cnpj')} and ab.cnpj not in (select cnpj from sed)""")
def mart_empresas(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(spark, folder)["empresas"]


_NODES = f"""{_SERVED}, ab as (select cnpj from walk where profundidade > 0),
  own as (select origem_id as cnpj, fonte, origem_nome from edges where origem_tipo = 'empresa' and origem_id in (select cnpj from ab)),
  nn as (select * from (select cnpj, origem_nome, row_number() over (partition by cnpj order by fonte, origem_nome nulls first) as k from own) where k = 1),
  firm as (select cnpj as id, 'Semente' as second, razao_social as name from sed
    union all select ab.cnpj, 'Holding', coalesce(emp.razao_social, nn.origem_nome) from ab left join emp on emp.cnpj_basico = left(ab.cnpj, 8) left join nn on nn.cnpj = ab.cnpj
    where {_CNPJ14.format('ab.cnpj')} and ab.cnpj not in (select cnpj from sed)),
  human as (select origem_id as id, origem_nome as name from (select s.*, row_number() over (partition by origem_id order by not {_CPF11.format('origem_documento')},
      case when fonte = 'fre' then 0 else 1 end, origem_nome nulls first, origem_documento nulls first) as k from serv s where origem_tipo = 'pessoa') where k = 1),
  ends as (select origem_id as id, origem_tipo as tipo, min(origem_nome) as name, bool_or(origem_nome is null) as missing from serv group by 1, 2),
  nodes as (select id, 'Empresa' as label, second, name, 'empresa' as tipo from firm union all select id, 'Pessoa', null, name, 'pessoa' from human
    union all select id, case tipo when 'pessoa' then 'Pessoa' when 'empresa' then 'Empresa' when 'estado' then 'Estado' else 'Parada' end, null, case when not missing then name end, tipo
      from ends where not exists (select 1 from firm where firm.id = ends.id and ends.tipo = 'empresa') and not exists (select 1 from human where human.id = ends.id and ends.tipo = 'pessoa')),
  lab as (select label from nodes union all select second from nodes where second is not null),
  fits as (select s.* from serv s where exists (select 1 from nodes n where n.id = s.origem_id and n.tipo = s.origem_tipo) and exists (select 1 from nodes n where n.id = s.cnpj and n.label = 'Empresa'))
"""


def _graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    m = _marts(spark, folder)
    nodes = _layer(spark, folder, "nodes", lambda: gp.graph_nodes(m["empresas"], m["pessoas"], m["vinculos"]))
    return nodes, _layer(spark, folder, "links", lambda: gp.graph_edges(m["vinculos"], nodes)), m["vinculos"]


@query(f"""with recursive {_NODES}, facts as (
      select 'nodes labelled ' || l as verificacao, (select count(*) from lab where label = l) as valor, 1 as least, cast(null as bigint) as most from (values ('Pessoa'), ('Empresa'), ('Semente'), ('Holding'), ('Estado')) t(l)
      union all select 'edges CONTROLADOR', (select count(*) from fits where papel = 'acionista_controlador'), 1, null
      union all select 'edges SOCIO', (select count(*) from fits where papel = 'socio'), 1, null
      union all select 'edges equal served rows', (select count(*) from fits), (select count(*) from serv), (select count(*) from serv)
      union all select 'edges point at a company', (select count(*) from fits), 1, null
      union all select 'the Union is no person', (select count(*) from nodes where label = 'Pessoa' and regexp_matches(upper(name), 'UNI[ÃA]O')), 0, 0
      union all select 'the Union is a state', (select count(*) from nodes where label = 'Estado' and regexp_matches(upper(name), 'UNI[ÃA]O')), 1, null
      union all select 'partner lists have no shares', (select count(*) from fits where papel = 'socio' and fonte = 'qsa' and percentual_on is not null), 0, 0
      union all select 'partner lists have no controller', (select count(*) from fits where fonte = 'qsa' and papel = 'acionista_controlador'), 0, 0
      union all select 'seeds without owner', (select count(*) from firm where second = 'Semente' and id not in (select cnpj from fits)), 0, null)
    select verificacao, valor, valor >= least and (most is null or valor <= most) as ok from facts""")
def graph_assertions(spark: SparkSession, folder: str) -> DataFrame:
    return gp.graph_checks(*_graph(spark, folder))


@query(f"with recursive {_NODES} select id, label, second as detalhe, name, tipo from nodes")
def graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _graph(spark, folder)[0].select("id", F.element_at("labels", 1).alias("label"), F.try_element_at("labels", F.lit(2)).alias("detalhe"), "name", "tipo")


@query(f"with recursive {_NODES} select label, count(*) as n from lab group by 1")
def graph_labels_counted(spark: SparkSession, folder: str) -> DataFrame:
    return gp.label_histogram(_graph(spark, folder)[0])


@query(f"""with recursive {_NODES}, per as (select f.id, count(s.cnpj) as titulares, count(case when s.papel = 'acionista_controlador' then 1 end) as controladores,
      count(case when s.origem_tipo = 'estado' then 1 end) as estados from firm f left join fits s on s.cnpj = f.id group by f.id)
    select id, titulares, controladores, estados from per""")
def graph_owners_counted(spark: SparkSession, folder: str) -> DataFrame:
    """How many owners of which kind every company has; companies without any are there too."""
    nodes, links, _ = _graph(spark, folder)
    return gp.owner_counts(nodes, links)


@query(f"""with recursive {_NODES}, most as (select cnpj from fits group by cnpj order by count(*) desc, cnpj limit 1),
      o as (select case f.origem_tipo when 'pessoa' then 'Pessoa' when 'empresa' then 'Empresa' when 'estado' then 'Estado' else 'Parada' end as origem,
        case papel when 'acionista_controlador' then 'CONTROLADOR' when 'acionista' then 'ACIONISTA' else 'SOCIO' end as rel, n.name as titular, percentual_on
        from fits f join most using (cnpj) join nodes n on n.id = f.origem_id and n.tipo = f.origem_tipo),
      placed as (select *, row_number() over (order by rel, coalesce(percentual_on, -1) desc, titular) as ordem from o)
    select ordem, origem, rel, titular from placed where ordem <= 3 union all select 4, null, null, '… ' || (count(*) - 3) || ' more' from o having count(*) > 3""")
def graph_owners_report(spark: SparkSession, folder: str) -> DataFrame:
    """The first three owners of the company that has most, and how many more there are."""
    nodes, links, _ = _graph(spark, folder)
    company = links.groupBy("to_id").count().orderBy(F.desc("count"), "to_id").first()
    report = gp.owners_report(nodes, links, company.to_id if company else "", 3)
    return report.select("ordem", "origem", "rel", F.coalesce("titular", F.when(F.col("rel").isNull(), F.col("descricao"))).alias("titular"))


@query(f"""with recursive {_SERVED} select case papel when 'acionista_controlador' then 'CONTROLADOR' when 'acionista' then 'ACIONISTA' when 'socio' then 'SOCIO' end as rel, count(*) as n from serv group by 1""")
def graph_relations(spark: SparkSession, folder: str) -> DataFrame:
    return gp.relation_histogram(gp.graph_edges(_marts(spark, folder)["vinculos"]))


# --- staging ----------------------------------------------------------------------
@query()
def staging_models(spark: SparkSession, folder: str) -> DataFrame:
    """The declared columns of all staging models."""
    return staging.describe_models(spark)


@query("""select ano, posicao, nome, razao_social, url_fonte, data_coleta from stg_valor_ranking""")
def staged_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking written out as text and staged again."""
    t = table(spark, folder, "stg_valor_ranking")
    raw = t.select(F.col("posicao").cast("string").alias("rank_2024"), F.col("nome").alias("empresa"), "razao_social", F.col("url_fonte").alias("source_url"), F.date_format("data_coleta", "dd/MM/yyyy").alias("retrieved_at"))
    return staging.stage(raw, "stg_valor_ranking", CONFIG)


def _round_trip(spark: SparkSession, folder: str, model: str) -> DataFrame:
    """A staged table written out as raw text, under its raw column names, and staged again."""
    t = table(spark, folder, model)
    raw = {source: F.col(name).cast("string").alias(source) for source, name, _ in staging.columns_of(model)}
    return staging.stage(t.select(*raw.values()), model, CONFIG)


def _register_round_trips() -> None:
    for model in ("stg_rf_socio", "stg_rf_empresa", "stg_cvm_fre_posicao_acionaria", "stg_cvm_cia_aberta"):
        def staged(spark: SparkSession, folder: str, model: str = model) -> DataFrame:
            return _round_trip(spark, folder, model)

        def same(name: str, kind: str) -> str:
            return f"nullif({_TRIM.format(name)}, '') as {name}" if kind in ("s", "doc") else name

        columns = ["ano"] * (model in staging.YEARS) + [same(name, kind) for _, name, kind in staging.columns_of(model)]
        QUERIES[f"staged_{model[4:]}"] = staged
        SQL[f"staged_{model[4:]}"] = f"select {', '.join(columns)} from {model}"


_register_round_trips()


# --- quality ------------------------------------------------------------------------
@query("""select 'unique_cnpj' as verificacao, 'error' as severidade, (select count(*) from (select cnpj from empresas where cnpj is not null group by cnpj having count(*) > 1)) as violacoes
    union all select 'not_null_date', 'warn', (select count(*) from empresas where motivo_entrada_date is null)
    union all select 'accepted_category', 'error', (select count(*) from empresas where motivo_entrada_categoria is not null and motivo_entrada_categoria not in ('semente', 'subida'))
    union all select 'length_14', 'error', (select count(*) from empresas where not (length(cnpj) = 14))
    union all select 'unique_pair', 'error', (select count(*) from (select cnpj, razao_social from empresas group by all having count(*) > 1))
    union all select 'seed_capital', 'warn', (select count(*) from empresas where motivo_entrada_categoria = 'semente' and capital_social is null)""")
def dq_empresas(spark: SparkSession, folder: str) -> DataFrame:
    checks = [
        q.Check("unique_cnpj", lambda d: q.unique(d, ["cnpj"])), q.Check("not_null_date", lambda d: q.not_null(d, "motivo_entrada_date"), "warn"),
        q.Check("accepted_category", lambda d: q.accepted_values(d, "motivo_entrada_categoria", ["semente", "subida"])),
        q.Check("length_14", lambda d: q.expression_is_true(d, "length(cnpj) = 14")), q.Check("unique_pair", lambda d: q.unique(d, ["cnpj", "razao_social"])),
        q.Check("seed_capital", lambda d: q.not_null(d, "capital_social"), "warn", "motivo_entrada_categoria = 'semente'"),
    ]
    return q.run_checks(table(spark, folder, "empresas"), checks)


@query("select id_vinculo, cnpj from vinculos v where cnpj is not null and not exists (select 1 from empresas e where e.cnpj = v.cnpj)")
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return q.relationships(table(spark, folder, "vinculos"), "cnpj", table(spark, folder, "empresas"), "cnpj").select("id_vinculo", "cnpj")
