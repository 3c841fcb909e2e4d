"""The walk over company edges and the three tables that are served."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.documents import is_cnpj14, is_cpf11
from ..operators.relational import flag_exists, ordered_concat, top_per_group
from ..operators.walk import bounded_walk, innermost

SERVED = (
    "origem_tipo origem_id origem_nome origem_documento cnpj papel fonte acionista_controlador participante_acordo_acionistas "
    "percentual_on percentual_total qualificacao tem_informacao_de_controle data_referencia fonte_documento"
).split()


def company_edges(edges: DataFrame) -> DataFrame:
    """(cnpj, origem_id, fonte): companies that own companies other than themselves."""
    return edges.where((F.col("origem_tipo") == "empresa") & is_cnpj14("origem_id") & (F.col("origem_id") != F.col("cnpj"))).select("cnpj", "origem_id", "fonte")


def walk_up(edges: DataFrame, seeds: DataFrame, config: Config = Config()) -> DataFrame:
    """(cnpj, profundidade, cnpj_origem, fonte_chegada) of all companies reached from the seeds.

    From a company the walk goes to the companies that own it, and to the
    vehicles through which persons own it.
    """
    vehicles = edges.where((F.col("origem_tipo") == "pessoa") & is_cnpj14("via_cnpj") & (F.col("via_cnpj") != F.col("cnpj"))).select(
        F.col("cnpj").alias("here"), F.col("via_cnpj").alias("there"), F.lit("via").alias("source")
    )
    owners = company_edges(edges).select(F.col("cnpj").alias("here"), F.col("origem_id").alias("there"), F.col("fonte").alias("source"))
    reached = bounded_walk(seeds.select(F.col("cnpj").alias("node")), owners.unionByName(vehicles), config.walk_depth)
    return reached.select(F.col("node").alias("cnpj"), F.col("depth").alias("profundidade"), F.col("came_from").alias("cnpj_origem"), F.col("source").alias("fonte_chegada"))


def companies_mart(seeds: DataFrame, edges: DataFrame, walk: DataFrame, companies: DataFrame, config: Config = Config()) -> DataFrame:
    """Seeds, and the companies that the walk added with what they are cited for."""
    above = walk.where("profundidade > 0").select("cnpj")
    owning = edges.where("origem_tipo = 'empresa'").withColumn("_issuer", F.col("cnpj")).drop("cnpj").withColumnRenamed("origem_id", "cnpj").join(above, "cnpj", "left_semi")
    filed = F.concat(F.lit("FRE id_documento "), F.coalesce("id_documento", F.lit("")), F.lit(" da companhia "), F.col("_issuer"))
    listed = F.concat(F.lit(f"QSA RF partição {config.partition_date} da empresa "), F.col("_issuer"))
    text = F.when(F.col("fonte") == "fre", filed).otherwise(listed)
    cited = ordered_concat(owning, ["cnpj"], text, [F.col("_issuer"), F.col("fonte")], "_citacao").join(owning.groupBy("cnpj").agg(F.min("data_referencia").alias("_desde")), "cnpj")
    via = edges.where((F.col("origem_tipo") == "pessoa") & is_cnpj14("via_cnpj")).select(F.col("via_cnpj").alias("_v"), F.col("cnpj").alias("_issuer"), "data_referencia").withColumnRenamed("_v", "cnpj").join(above, "cnpj", "left_semi")
    via_cited = ordered_concat(via, ["cnpj"], F.concat(F.lit("FRE Acionista_Relacionado da companhia "), F.col("_issuer")), [F.col("_issuer")], "_via").join(
        via.groupBy("cnpj").agg(F.min("data_referencia").alias("_via_desde")), "cnpj"
    )
    # of several edges the name of the first by source and name; aggregated before any join
    names = owning.groupBy("cnpj").agg(F.min(F.struct("fonte", "origem_nome")).alias("_n")).select("cnpj", F.col("_n.origem_nome").alias("_nome"))
    registry = companies.where(F.col("data") == F.lit(config.partition_date).cast("date")).select(F.col("cnpj_basico").alias("_raiz"), F.col("razao_social").alias("_razao"), F.col("capital_social").alias("_capital"))
    registry = registry.groupBy("_raiz").agg(F.min("_razao").alias("_razao"), F.max("_capital").alias("_capital"))
    added = above.where(is_cnpj14("cnpj")).join(seeds.select("cnpj"), "cnpj", "left_anti").withColumn("_raiz", F.left("cnpj", F.lit(8)))
    joined = added.join(registry, "_raiz", "left").join(names, "cnpj", "left").join(cited, "cnpj", "left").join(via_cited, "cnpj", "left")
    new = joined.select(
        "cnpj", F.coalesce("_razao", "_nome").alias("razao_social"), F.col("_capital").alias("capital_social"), F.lit("subida").alias("motivo_entrada_categoria"),
        F.coalesce("_citacao", "_via").alias("motivo_entrada_descricao"), F.coalesce("_desde", "_via_desde").alias("motivo_entrada_date"),
    )
    return seeds.select(*new.columns).unionByName(new)


def edges_mart(edges: DataFrame, walk: DataFrame) -> DataFrame:
    """Edges of visited companies, with persons moved from the issuer to their innermost vehicle.

    A company edge goes if its owner already owns the vehicle it came through. A
    person with a vehicle leaves the issuer and appears, without shares, at the
    innermost vehicle, unless that vehicle's own book has the person.
    """
    visited = edges.join(walk.select("cnpj"), "cnpj", "left_semi")
    through = is_cnpj14("via_cnpj")
    person, company = F.col("origem_tipo") == "pessoa", F.col("origem_tipo") == "empresa"
    owns = company_edges(edges).select(F.col("origem_id").alias("owner"), F.col("cnpj").alias("owned")).distinct()
    own_via = visited.withColumns({"owner": F.col("origem_id"), "owned": F.when(through, F.col("via_cnpj"))})
    flagged = flag_exists(own_via, owns, ["owner", "owned"], "_copia")
    book = flagged.where(~(person & through) & ~(company & through & F.col("_copia")))
    vias = visited.where(person & through).select("origem_id", "cnpj", F.col("via_cnpj").alias("via"))
    inner = innermost(vias, owns, ["origem_id", "cnpj"]).withColumnRenamed("via", "via_cnpj")
    moved = visited.where(person & through).join(inner, ["origem_id", "cnpj", "via_cnpj"], "left_semi").withColumn("cnpj", F.col("via_cnpj"))
    listed = book.where(person).select("origem_id", "cnpj").distinct()
    none = F.lit(None).cast("double")
    invented = moved.join(listed, ["origem_id", "cnpj"], "left_anti").withColumns({"percentual_on": none, "percentual_total": none})
    every = book.select(*SERVED).unionByName(invented.select(*SERVED))
    order = [F.col("percentual_on").isNull(), F.col("fonte_documento"), F.col("percentual_on").desc(), F.col("papel"), F.col("origem_nome"), F.col("origem_documento"), F.col("qualificacao")]
    return top_per_group(every, ["origem_id", "cnpj", "fonte"], order)


def persons_mart(served: DataFrame, edges: DataFrame) -> DataFrame:
    """(pessoa_id, nome, cpf): the best-documented row of each person; the number may come from any edge."""
    full = edges.where((F.col("origem_tipo") == "pessoa") & is_cpf11("origem_documento")).groupBy("origem_id").agg(F.min("origem_documento").alias("_cpf"))
    has = is_cpf11("origem_documento")
    best = top_per_group(served.where("origem_tipo = 'pessoa'"), ["origem_id"], [F.when(has, 0).otherwise(1), F.when(F.col("fonte") == "fre", 0).otherwise(1), F.col("origem_nome"), F.col("origem_documento")])
    return best.join(full, "origem_id", "left").select(F.col("origem_id").alias("pessoa_id"), F.col("origem_nome").alias("nome"), F.coalesce(F.when(has, F.col("origem_documento")), "_cpf").alias("cpf"))
