"""Companies of the ranking lists, found in the registry by exact name, by prefix or through other registers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.names import company_key, first_parenthetical, strip_legal_suffix, text_before_dash
from ..operators.prefixes import prefix_join
from ..operators.relational import ordered_concat, top_per_group
from .ownership import head_offices

#: The three lists in order of priority, as they are cited.
LISTS = ("ranking industrial", "bancos", "seguradoras")
LEAST_KEY, LEAST_STRIPPED = 8, 5


def listed_names(ranking: DataFrame, banks: DataFrame, insurers: DataFrame, config: Config) -> DataFrame:
    """(chave_nome, nome, razao_social, posicao, lista, citacao) of the three lists."""
    out = None
    for order, (title, df) in enumerate(zip(LISTS, (ranking, banks, insurers)), 1):
        legal = F.coalesce("razao_social", "nome")
        cited = F.concat(F.lit(f"{config.ranking_title}, {title}, posição "), F.col("posicao").cast("string"))
        part = df.select(company_key(legal).alias("chave_nome"), "nome", legal.alias("razao_social"), "posicao", F.lit(order).alias("lista"), cited.alias("citacao"))
        out = part if out is None else out.unionByName(part)
    return out


def search_keys(chosen: DataFrame) -> DataFrame:
    """Each name's keys by priority: the whole, what stands before a dash, what stands in parentheses."""
    legal = F.col("razao_social")
    options = F.array(
        F.struct(F.col("chave_nome").alias("chave"), F.lit(1).alias("prioridade")),
        F.when(legal.contains(" - "), F.struct(company_key(text_before_dash(legal)).alias("chave"), F.lit(2).alias("prioridade"))),
        F.when(legal.contains("("), F.struct(company_key(first_parenthetical(legal)).alias("chave"), F.lit(3).alias("prioridade"))),
    )
    return chosen.select("chave_nome", F.explode(F.filter(options, lambda o: o.isNotNull())).alias("o")).select("chave_nome", "o.*")


def seed_companies(
    ranking: DataFrame, banks: DataFrame, insurers: DataFrame, companies: DataFrame, establishments: DataFrame, registers: list[tuple[DataFrame, str, str | None]], config: Config = Config()
) -> DataFrame:
    """(cnpj, razao_social, capital_social, motivo_entrada_*): one row per company found.

    ``registers``: (table with id_cnpj, name column, status column or None) in
    order of trust. Exact names come first, then names of which one begins with
    the other (keys of 8 characters on, or of 5 once the legal form is taken
    off; any registry key counts, an empty one included). Names that the
    registry lacks are looked up in the registers, then in ``config.exceptions``.
    """
    lists = listed_names(ranking, banks, insurers, config)
    chosen = top_per_group(lists, ["chave_nome"], [F.col("lista"), F.col("posicao")]).select("chave_nome", "nome", "razao_social")
    reasons = ordered_concat(lists, ["chave_nome"], F.col("citacao"), [F.col("lista"), F.col("posicao")], "motivo")
    keys = search_keys(chosen)
    now = companies.where((F.col("data") == F.lit(config.partition_date).cast("date")) & F.col("razao_social").isNotNull()).select(
        company_key("razao_social").alias("_rf"), "cnpj_basico", F.col("razao_social").alias("rf_razao"), "capital_social"
    )
    best = [F.col("prioridade"), F.col("capital_social").desc_nulls_last(), F.col("cnpj_basico")]
    fields = ["chave_nome", "cnpj_basico", "rf_razao", "capital_social"]
    exact = top_per_group(keys.where("chave != ''").join(now, F.col("chave") == F.col("_rf")), ["chave_nome"], best).select(*fields)
    missing = keys.join(exact.select("chave_nome"), "chave_nome", "left_anti")
    whole = missing.where(F.length("chave") >= LEAST_KEY)
    stripped = missing.select("chave_nome", strip_legal_suffix("chave").alias("chave"), F.lit(4).alias("prioridade")).where(F.length("chave") >= LEAST_STRIPPED)
    near = prefix_join(whole.unionByName(stripped).distinct(), now, "chave", "_rf")
    found = exact.unionByName(top_per_group(near, ["chave_nome"], best).select(*fields))
    offices = head_offices(establishments, found, config).withColumnRenamed("cnpj", "_matriz")
    book = None
    for order, (df, name, status) in enumerate(registers, 1):
        inactive = F.when(F.col(status) == "ATIVO", 0).otherwise(1) if status else F.lit(0)
        part = df.where(F.col("id_cnpj").isNotNull() & F.col(name).isNotNull()).select(company_key(name).alias("chave"), F.col("id_cnpj").alias("_cadastro"), inactive.alias("_inativo"), F.lit(order).alias("_origem"))
        book = part if book is None else book.unionByName(part)
    listed = top_per_group(
        keys.where("chave != ''").join(book, "chave"), ["chave_nome"], [F.col("prioridade"), F.col("_inativo"), F.col("_origem"), F.col("_cadastro")]
    ).select("chave_nome", "_cadastro")
    spark = ranking.sparkSession
    exceptions = spark.createDataFrame(list(config.exceptions), "razao_social string, _excecao string")
    resolved = (
        chosen.join(reasons, "chave_nome").join(found, "chave_nome", "left").join(offices, "cnpj_basico", "left")
        .join(listed, "chave_nome", "left").join(exceptions, "razao_social", "left")
        .withColumn("cnpj", F.coalesce("_matriz", "_cadastro", "_excecao")).where("cnpj is not null")
    )
    capital = now.select(F.col("cnpj_basico").alias("_raiz"), F.col("capital_social").alias("_capital"))
    filled = resolved.withColumn("_raiz", F.when(F.col("cnpj_basico").isNull(), F.left("cnpj", F.lit(8)))).join(capital, "_raiz", "left")
    one = filled.groupBy("cnpj").agg(
        F.min(F.coalesce("rf_razao", "razao_social")).alias("razao_social"), F.max(F.coalesce("capital_social", "_capital")).alias("capital_social"),
    )
    cited = ordered_concat(resolved, ["cnpj"], F.col("motivo"), [F.col("motivo")], "motivo_entrada_descricao")
    return one.join(cited, "cnpj").select(
        "cnpj", "razao_social", "capital_social", F.lit("semente").alias("motivo_entrada_categoria"), "motivo_entrada_descricao",
        F.lit(config.publication_date).cast("date").alias("motivo_entrada_date"),
    )
