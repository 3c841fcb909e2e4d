"""Ownership edges from filings and partner lists, with owners classified and persons resolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.documents import cpf_mask6, is_cnpj14, is_cpf11, is_placeholder_cnpj, matriz_order, person_id_from_cpf, prefix8_from_cnpj14
from ..functions.names import company_key, first_token, fold_upper, last_token, person_key, person_origin_id, token_count
from ..operators.prefixes import fuzzy_block_join
from ..operators.relational import cascade, latest_group, top_per_group, unique_keys
from ..session import cut

# --- fixed values -----------------------------------------------------------
#: Partner qualifications that mean ownership. 30 and 50 are labelled otherwise by the registry and kept.
OWNERSHIP = (
    "20 21 22 23 24 25 26 28 29 30 31 34 37 38 47 48 49 50 52 53 54 55 56 57 58 59 65 66 67 68 74 75 78 79"
).split()
STATE_KEYS = ("UNIAO", "UNIAOFEDERAL", "TESOURONACIONAL", "FAZENDANACIONAL")
STATE_COMPANY_NATURES = ("2011", "2038")
# -----------------------------------------------------------------------------

COMMON = (
    "fonte cnpj cnpj_basico id_documento origem_nome origem_documento tipo_pessoa_acionista qualificacao qsa_tipo "
    "indicador_acionista_controlador indicador_participante_acordo_acionistas percentual_on percentual_total "
    "data_referencia fonte_documento tem_informacao_de_controle via via_documento"
).split()
EDGE = (
    "origem_tipo origem_id origem_nome origem_documento cnpj papel fonte acionista_controlador participante_acordo_acionistas "
    "percentual_on percentual_total qualificacao tem_informacao_de_controle data_referencia fonte_documento cnpj_basico id_documento via via_cnpj"
).split()


def recent_positions(fre: DataFrame) -> DataFrame:
    """Named holders of each issuer's latest filed document (greatest id as text)."""
    filed = fre.where("id_cnpj is not null and id_documento is not null")
    last = latest_group(filed, "id_cnpj", "id_documento").where("nome_acionista is not null")
    return last.select(
        F.col("id_cnpj").alias("cnpj"), "id_documento", "data_referencia", "id_acionista", "nome_acionista", "tipo_pessoa_acionista", "documento_acionista",
        "proporcao_acao_ordinaria_circulacao", "proporcao_total_acao_circulacao", "indicador_acionista_controlador",
        "indicador_participante_acordo_acionistas", "nome_acionista_relacionado", "documento_acionista_relacionado",
    )


def head_offices(establishments: DataFrame, roots: DataFrame, config: Config) -> DataFrame:
    """(cnpj_basico, cnpj): the head office of the roots asked for; only their rows reach the window."""
    there = establishments.where(F.col("data") == F.lit(config.partition_date).cast("date"))
    needed = there.join(roots.select("cnpj_basico").distinct(), "cnpj_basico", "left_semi")
    return top_per_group(needed.select("cnpj_basico", "cnpj", "cnpj_ordem", "identificador_matriz_filial", "situacao_cadastral"), ["cnpj_basico"], matriz_order()).select("cnpj_basico", "cnpj")


def _text(*names: str) -> dict[str, Column]:
    return {n: F.lit(None).cast("string") for n in names}


def filed_edges(positions: DataFrame, config: Config) -> DataFrame:
    return positions.select(
        F.lit("fre").alias("fonte"), "cnpj", prefix8_from_cnpj14("cnpj").alias("cnpj_basico"), "id_documento",
        F.col("nome_acionista").alias("origem_nome"), F.col("documento_acionista").alias("origem_documento"), "tipo_pessoa_acionista",
        "indicador_acionista_controlador", "indicador_participante_acordo_acionistas",
        F.col("proporcao_acao_ordinaria_circulacao").alias("percentual_on"), F.col("proporcao_total_acao_circulacao").alias("percentual_total"),
        "data_referencia", F.concat(F.lit(f"{config.filing_label} id_documento="), "id_documento").alias("fonte_documento"),
        F.lit(True).alias("tem_informacao_de_controle"), F.col("nome_acionista_relacionado").alias("via"), F.col("documento_acionista_relacionado").alias("via_documento"),
    ).withColumns(_text("qualificacao", "qsa_tipo")).select(*COMMON)


def partner_edges(partners: DataFrame, establishments: DataFrame, config: Config) -> DataFrame:
    """Partners that own, at their company's head office. Roots without an establishment drop out."""
    owning = partners.where((F.col("data") == F.lit(config.partition_date).cast("date")) & F.col("qualificacao").isin(*OWNERSHIP) & F.col("nome").isNotNull())
    offices = head_offices(establishments, owning, config)
    none = F.lit(None).cast("double")
    return owning.join(offices, "cnpj_basico").select(
        F.lit("qsa").alias("fonte"), "cnpj", "cnpj_basico", F.col("nome").alias("origem_nome"), F.col("documento").alias("origem_documento"), "qualificacao",
        F.col("tipo").alias("qsa_tipo"), none.alias("percentual_on"), none.alias("percentual_total"), F.col("data").alias("data_referencia"),
        F.concat(F.lit("rf.socios partição "), F.col("data").cast("string"), F.lit(" cnpj_basico="), "cnpj_basico").alias("fonte_documento"),
        F.lit(False).alias("tem_informacao_de_controle"),
    ).withColumns(_text("id_documento", "tipo_pessoa_acionista", "indicador_acionista_controlador", "indicador_participante_acordo_acionistas", "via", "via_documento")).select(*COMMON)


def with_owner_numbers(edges: DataFrame, companies: DataFrame, establishments: DataFrame, config: Config) -> DataFrame:
    """Adds owner_cnpj, via_cnpj, natureza_juridica, ente_federativo, and the name keys they came from.

    A name that exactly one registry row bears stands for that company where the
    document is no full number. Keys are computed once; names that nobody asks
    for never reach the establishments.
    """
    now = companies.where((F.col("data") == F.lit(config.partition_date).cast("date")))
    named = now.where("razao_social is not null").select(company_key("razao_social").alias("_chave"), "cnpj_basico")
    no_number = lambda c: F.length(F.coalesce(c, F.lit(""))) != 14
    keyed = edges.withColumns({
        "chave_nome": company_key("origem_nome"),
        "_busca": F.when(no_number("origem_documento"), company_key("origem_nome")),
        "_busca_via": F.when(F.col("via").isNotNull() & no_number("via_documento"), company_key("via")),
    })
    asked = keyed.select(F.explode(F.array("_busca", "_busca_via")).alias("_chave")).where("_chave is not null").distinct()
    unique = unique_keys(named, "_chave", "cnpj_basico").join(asked, "_chave", "left_semi")
    offices = head_offices(establishments, unique, config)
    known = unique.join(offices, "cnpj_basico").select("_chave", F.col("cnpj").alias("_cnpj"))
    owner = known.select(F.col("_chave").alias("_busca"), F.col("_cnpj").alias("_dono"))
    vehicle = known.select(F.col("_chave").alias("_busca_via"), F.col("_cnpj").alias("_veiculo"))
    found = keyed.join(owner, "_busca", "left").join(vehicle, "_busca_via", "left").withColumns({
        "owner_cnpj": F.when(is_cnpj14("origem_documento"), F.col("origem_documento")).otherwise(F.col("_dono")),
        "via_cnpj": F.when(is_cnpj14("via_documento"), F.col("via_documento")).otherwise(F.col("_veiculo")),
    })
    nature = now.select(F.col("cnpj_basico").alias("_raiz"), "natureza_juridica", "ente_federativo")
    rooted = found.withColumn("_raiz", F.when(is_cnpj14("owner_cnpj"), F.left("owner_cnpj", F.lit(8))))
    return rooted.join(nature, "_raiz", "left").drop("_raiz", "_busca", "_busca_via", "_dono", "_veiculo")


def owner_kind() -> Column:
    """The ordered rules that sort owners into seven kinds; unknown conditions fall through."""
    name, person = fold_upper("origem_nome"), fold_upper("tipo_pessoa_acionista")
    nature, qsa = F.col("natureza_juridica"), F.col("qsa_tipo")
    rules = [
        (name == "OUTROS", "outros"),
        (name.contains("TESOURARIA"), "tesouraria"),
        (nature.isin(*STATE_COMPANY_NATURES), "empresa"),
        (nature.startswith("1") | F.col("ente_federativo").isNotNull() | F.col("chave_nome").isin(*STATE_KEYS), "estado"),
        (person.contains("FISICA") | (person == "PF") | (qsa == "2") | (F.length("origem_documento") == 11), "pessoa"),
        (is_placeholder_cnpj("origem_documento"), "estrangeiro"),
        ((qsa == "3") & F.col("owner_cnpj").isNull(), "estrangeiro"),
        (is_cnpj14("owner_cnpj"), "empresa"),
        (person.contains("JURIDICA") | (person == "PJ") | (qsa == "1"), "nao_resolvido"),
        (qsa == "3", "estrangeiro"),
    ]
    out = F.lit("nao_resolvido")
    for condition, kind in reversed(rules):
        out = F.when(condition, kind).otherwise(out)
    return out


def identified(edges: DataFrame) -> DataFrame:
    """Edges with the owner's kind, id, role and flags, persons still by their own number or name."""
    typed = edges.withColumn("origem_tipo", owner_kind())
    kind, key = F.col("origem_tipo"), F.col("chave_nome")
    own = (
        F.when(kind == "pessoa", person_origin_id("origem_documento", "origem_nome", "cnpj"))
        .when(kind == "empresa", F.col("owner_cnpj"))
        .when(kind == "estado", F.coalesce("owner_cnpj", F.concat(F.lit("estado:"), key)))
        .when(kind.isin("outros", "tesouraria"), F.concat(kind, F.lit(":"), key, F.lit("@"), F.col("cnpj")))
        .otherwise(F.concat(kind, F.lit(":"), key))
    )
    filed = F.col("fonte") != "qsa"
    yes_no = lambda c: F.when(filed & (F.col(c) == "S"), True).when(filed & (F.col(c) == "N"), False)
    role = F.when(~filed, "socio").when(F.col("indicador_acionista_controlador") == "S", "acionista_controlador").otherwise("acionista")
    return typed.withColumns({
        "origem_id": own, "papel": role, "acionista_controlador": yes_no("indicador_acionista_controlador"),
        "participante_acordo_acionistas": yes_no("indicador_participante_acordo_acionistas"),
    }).select(*EDGE)


def person_features(persons: DataFrame) -> DataFrame:
    """Adds the name key, the six shared digits, the full number, tokens and the id by number."""
    keyed = persons.withColumns({"chave_pessoa": person_key("origem_nome"), "mask6": cpf_mask6("origem_documento"), "cpf11": F.when(is_cpf11("origem_documento"), F.col("origem_documento"))})
    return keyed.withColumns({
        "n_tok": token_count("chave_pessoa"), "primeiro": first_token("chave_pessoa"), "ultimo": last_token("chave_pessoa"),
        "pessoa_id_cpf": F.when(F.col("cpf11").isNotNull(), person_id_from_cpf("cpf11")),
    })


def resolve_persons(edges: DataFrame) -> DataFrame:
    """Person edges with one id per natural person, as far as numbers and names tell.

    In this order: the own number; the one number cited with the same name and
    digits; with the same name; with the same first and last token and digits;
    by a near name, if it leads to one id; a name with one mask only; a name of
    three or more tokens; else the name within its company. Counts are taken
    over all edges, by groups that are joined back, so a frequent name gathers
    nothing in one place.
    """
    people = cut(person_features(edges.where("origem_tipo = 'pessoa'")))
    cited = people.where("cpf11 is not null")

    def single(keys: list[str], name: str) -> DataFrame:
        """Keys under which exactly one number is cited, with its id."""
        rows = cited
        for k in keys:
            rows = rows.where(F.col(k).isNotNull())
        return rows.groupBy(*keys).agg(F.countDistinct("cpf11").alias("_n"), F.min("pessoa_id_cpf").alias(name)).where("_n = 1").drop("_n")

    by_name = people.groupBy("chave_pessoa").agg(F.count("cpf11").alias("n_cpf"), F.countDistinct("mask6").alias("n_mask"), F.first("n_tok").alias("_t"))
    anchors = cited.select(F.col("chave_pessoa").alias("chave_ancora"), F.col("pessoa_id_cpf").alias("ancora")).distinct()
    near = fuzzy_block_join(by_name.where("n_cpf = 0").select("chave_pessoa"), anchors, "chave_pessoa", "chave_ancora")
    one_anchor = near.groupBy("chave_pessoa").agg(F.countDistinct("ancora").alias("_n"), F.min("ancora").alias("_proximo")).where("_n = 1").drop("_n")
    counted = people.join(by_name.select("chave_pessoa", "n_mask"), "chave_pessoa")
    named = F.concat(F.lit("nome:"), F.col("chave_pessoa"))
    own = F.when(F.col("n_mask") == 1, named).when(F.col("n_tok") >= 3, named).otherwise(F.col("origem_id"))
    lookups = [
        (single(["chave_pessoa", "mask6"], "_a"), ["chave_pessoa", "mask6"], "_a"),
        (single(["chave_pessoa"], "_b"), ["chave_pessoa"], "_b"),
        (single(["primeiro", "ultimo", "mask6"], "_c"), ["primeiro", "ultimo", "mask6"], "_c"),
        (one_anchor, ["chave_pessoa"], "_proximo"),
    ]
    found = cascade(counted, lookups, "_id", own)
    return found.withColumn("origem_id", F.coalesce("pessoa_id_cpf", "_id")).select(*EDGE)


def ownership_edges(fre: DataFrame, partners: DataFrame, companies: DataFrame, establishments: DataFrame, config: Config = Config()) -> DataFrame:
    """All ownership edges with resolved owners (19 columns)."""
    both = filed_edges(recent_positions(fre), config).unionByName(partner_edges(partners, establishments, config))
    base = cut(identified(with_owner_numbers(both, companies, establishments, config)))
    return resolve_persons(base).unionByName(base.where("origem_tipo != 'pessoa'"))
