"""Typed staging of the raw tables: rename, type, no business filter.

A model is a list of columns ``raw name -> name: type``. Types: ``s`` cleaned
text, ``i`` whole number, ``f`` floating point, ``n`` exact money, ``b`` money
that may be written with a decimal comma, ``d`` date, ``e`` date as yyyyMMdd,
``14`` and ``8`` company number and root, ``doc`` identifying document, ``14x``
a number only where all 14 digits are there, ``p2`` and ``p4`` padded codes.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..functions import documents as doc
from ..functions import hygiene as hy

TYPES: dict[str, tuple[Callable[[Column], Column], T.DataType]] = {
    "s": (hy.clean_string, T.StringType()),
    "i": (hy.to_int64, T.LongType()),
    "f": (hy.to_float64, T.DoubleType()),
    "n": (hy.to_numeric, T.DecimalType(38, 9)),
    "b": (hy.parse_br_numeric, T.DecimalType(38, 9)),
    "d": (hy.to_date, T.DateType()),
    "e": (hy.to_date_yyyymmdd, T.DateType()),
    "14": (doc.cnpj14, T.StringType()),
    "8": (doc.cnpj8, T.StringType()),
    "doc": (doc.identifying_document, T.StringType()),
    "14x": (lambda c: F.when(F.length(hy.digits_only(c)) == 14, hy.digits_only(c)), T.StringType()),
    "p2": (lambda c: hy.padded_code(c, 2), T.StringType()),
    "p4": (lambda c: hy.padded_code(c, 4), T.StringType()),
    "cents": (lambda c: (hy.to_numeric(c) / 100).cast(hy.MONEY), T.DecimalType(38, 9)),
    "month": (lambda c: hy.year_month(hy.to_date(c)), T.StringType()),
}

# --- fixed values: raw columns, names and types of the models ------------------
_LIST = "rank_2024 posicao i; empresa nome s; razao_social razao_social s; source_url url_fonte s; retrieved_at data_coleta d"
MODELS = {
    "stg_valor_ranking": _LIST,
    "stg_valor_banco": _LIST,
    "stg_valor_seguradora": _LIST,
    "stg_valor_empresa_inventario": (
        "identificador identificador s; identificador id_cnpj 14x; nome nome s; tipo_societario tipo_societario s; no_grafo indicador_grafo s; "
        "porque motivo s; situacao_do_passeio situacao_passeio s; no_formulario indicador_formulario s; notas notas s"
    ),
    "stg_cvm_cia_aberta": (
        "CNPJ_CIA id_cnpj 14; CD_CVM id_cvm s; DENOM_SOCIAL razao_social s; DENOM_COMERC nome_comercial s; DT_REG data_registro d; DT_CONST data_constituicao d; "
        "DT_CANCEL data_cancelamento d; MOTIVO_CANCEL motivo_cancelamento s; SIT situacao s; DT_INI_SIT data_inicio_situacao d; SETOR_ATIV setor_atividade s; "
        "TP_MERC tipo_mercado s; CATEG_REG categoria_registro s; DT_INI_CATEG data_inicio_categoria d; SIT_EMISSOR situacao_emissor s; "
        "DT_INI_SIT_EMISSOR data_inicio_situacao_emissor d; CONTROLE_ACIONARIO tipo_controle_acionario s; TP_ENDER tipo_endereco s; LOGRADOURO logradouro s; "
        "COMPL complemento s; BAIRRO bairro s; MUN nome_municipio s; UF sigla_uf s; PAIS nome_pais s; CEP cep s; DDD_TEL ddd s; TEL telefone s; DDD_FAX ddd_fax s; "
        "FAX fax s; EMAIL email s; TP_RESP tipo_responsavel s; RESP nome_responsavel s; DT_INI_RESP data_inicio_responsavel d; LOGRADOURO_RESP logradouro_responsavel s; "
        "COMPL_RESP complemento_responsavel s; BAIRRO_RESP bairro_responsavel s; MUN_RESP nome_municipio_responsavel s; UF_RESP sigla_uf_responsavel s; "
        "PAIS_RESP nome_pais_responsavel s; CEP_RESP cep_responsavel s; DDD_TEL_RESP ddd_responsavel s; TEL_RESP telefone_responsavel s; "
        "DDD_FAX_RESP ddd_fax_responsavel s; FAX_RESP fax_responsavel s; EMAIL_RESP email_responsavel s; CNPJ_AUDITOR id_cnpj_auditor 14; AUDITOR nome_auditor s"
    ),
    "stg_cvm_fre_posicao_acionaria": (
        "CNPJ_Companhia id_cnpj 14; Data_Referencia data_referencia d; Versao versao i; ID_Documento id_documento s; Nome_Companhia nome_companhia s; "
        "ID_Acionista id_acionista s; Acionista nome_acionista s; Tipo_Pessoa_Acionista tipo_pessoa_acionista s; CPF_CNPJ_Acionista documento_acionista doc; "
        "ID_Acionista_Relacionado id_acionista_relacionado s; Acionista_Relacionado nome_acionista_relacionado s; "
        "Tipo_Pessoa_Acionista_Relacionado tipo_pessoa_acionista_relacionado s; CPF_CNPJ_Acionista_Relacionado documento_acionista_relacionado doc; "
        "Quantidade_Acao_Ordinaria_Circulacao quantidade_acao_ordinaria_circulacao i; Percentual_Acao_Ordinaria_Circulacao proporcao_acao_ordinaria_circulacao f; "
        "Quantidade_Acao_Preferencial_Circulacao quantidade_acao_preferencial_circulacao i; Percentual_Acao_Preferencial_Circulacao proporcao_acao_preferencial_circulacao f; "
        "Quantidade_Total_Acoes_Circulacao quantidade_total_acao_circulacao i; Percentual_Total_Acoes_Circulacao proporcao_total_acao_circulacao f; "
        "Nacionalidade nacionalidade s; Sigla_UF sigla_uf s; Residente_Exterior indicador_residente_exterior s; Representante_Legal nome_representante_legal s; "
        "Tipo_Pessoa_Representante_Legal tipo_pessoa_representante_legal s; CPF_CNPJ_Representante_legal documento_representante_legal doc; "
        "Data_Composicao_Capital_Social data_composicao_capital_social s; Data_Ultima_Alteracao data_ultima_alteracao d; "
        "Acionista_Controlador indicador_acionista_controlador s; Participante_Acordo_Acionistas indicador_participante_acordo_acionistas s"
    ),
    "stg_cvm_fre_capital_social": (
        "CNPJ_Companhia id_cnpj 14; Data_Referencia data_referencia d; Versao versao i; ID_Documento id_documento s; Nome_Companhia nome_companhia s; "
        "ID_Capital_Social id_capital_social s; Tipo_Capital tipo_capital s; Data_Autorizacao_Aprovacao data_autorizacao_aprovacao s; Valor_Capital valor_capital n; "
        "Prazo_Integralizacao prazo_integralizacao s; Quantidade_Acoes_Ordinarias quantidade_acao_ordinaria i; "
        "Quantidade_Acoes_Preferenciais quantidade_acao_preferencial i; Quantidade_Total_Acoes quantidade_total_acao i"
    ),
    "stg_cvm_fca_valor_mobiliario": (
        "CNPJ_Companhia id_cnpj 14; Data_Referencia data_referencia d; Versao versao i; ID_Documento id_documento s; Nome_Empresarial razao_social s; "
        "Valor_Mobiliario tipo_valor_mobiliario s; Sigla_Classe_Acao_Preferencial sigla_classe_acao_preferencial s; Classe_Acao_Preferencial classe_acao_preferencial s; "
        "Codigo_Negociacao ticker s; Composicao_BDR_Unit composicao_bdr_unit s; Mercado tipo_mercado s; Sigla_Entidade_Administradora sigla_entidade_administradora s; "
        "Entidade_Administradora nome_entidade_administradora s; Data_Inicio_Negociacao data_inicio_negociacao d; Data_Fim_Negociacao data_fim_negociacao d; "
        "Segmento segmento s; Data_Inicio_Listagem data_inicio_listagem d; Data_Fim_Listagem data_fim_listagem d"
    ),
    "stg_bcb_entidade_supervisionada": (
        "database data_base d; codigoCNPJ14 id_cnpj 14; codigoCNPJ8 cnpj_basico 8; nomeEntidadeInteresse nome s; "
        "codigoTipoSituacaoPessoaJuridica tipo_situacao s; codigoTipoEntidadeSupervisionada tipo_entidade s"
    ),
    "stg_bcb_ifdata_cadastro": (
        "Data data d; Data ano_mes month; CodInst id_instituicao s; CodConglomeradoPrudencial id_conglomerado_prudencial s; "
        "CnpjInstituicaoLider cnpj_basico_lider 8; NomeInstituicao nome s; Situacao situacao s"
    ),
    "stg_bcb_ifdata_ativo_total": (
        "AnoMes ano_mes s; TipoInstituicao tipo_instituicao i; CodInst id_instituicao s; NumeroRelatorio numero_relatorio s; Conta conta s; NomeColuna nome_conta s; Saldo saldo n"
    ),
    "stg_susep_dado_cadastral": "entcgc id_cnpj 14; entnome nome s; mercodigo tipo_mercado s",
    "stg_susep_receita_seguro": "cnpj id_cnpj 14; entnome nome s; mesreferencia mes_referencia s; grupo grupo s; ramo ramo s; valor valor n",
    "stg_b3_empresa_listada": "cnpj id_cnpj 14; codeCVM id_cvm s; issuingCompany codigo_emissor s; companyName razao_social s; tradingName nome_comercial s; type tipo s",
    "stg_b3_empresa_listada_complemento": (
        "code codigo_emissor s; codeCVM id_cvm s; tradingName nome_comercial s; numberCommonShares quantidade_acao_ordinaria b; "
        "numberPreferredShares quantidade_acao_preferencial b; totalNumberShares quantidade_total_acao b"
    ),
    "stg_b3_cotahist": "DATA_PREGAO data_pregao e; CODNEG ticker s; CODBDI codigo_bdi s; TPMERC tipo_mercado s; PREULT preco_fechamento cents; NUMNEG quantidade_negocio i",
    "stg_rf_empresa": (
        "data data d; ano ano i; mes mes i; cnpj_basico cnpj_basico 8; razao_social razao_social s; natureza_juridica natureza_juridica p4; "
        "qualificacao_responsavel qualificacao_responsavel p2; capital_social capital_social f; porte porte s; ente_federativo ente_federativo s"
    ),
    "stg_rf_estabelecimento": (
        "data data d; ano ano i; mes mes i; cnpj cnpj 14; cnpj_basico cnpj_basico 8; cnpj_ordem cnpj_ordem p4; cnpj_dv cnpj_dv p2; "
        "identificador_matriz_filial identificador_matriz_filial s; nome_fantasia nome_fantasia s; situacao_cadastral situacao_cadastral p2; "
        "data_situacao_cadastral data_situacao_cadastral d; motivo_situacao_cadastral motivo_situacao_cadastral s; nome_cidade_exterior nome_cidade_exterior s; "
        "id_pais id_pais s; data_inicio_atividade data_inicio_atividade d; cnae_fiscal_principal cnae_fiscal_principal s; cnae_fiscal_secundaria cnae_fiscal_secundaria s; "
        "sigla_uf sigla_uf s; id_municipio id_municipio s; id_municipio_rf id_municipio_rf s; tipo_logradouro tipo_logradouro s; logradouro logradouro s; numero numero s; "
        "complemento complemento s; bairro bairro s; cep cep s; ddd_1 ddd_1 s; telefone_1 telefone_1 s; ddd_2 ddd_2 s; telefone_2 telefone_2 s; ddd_fax ddd_fax s; fax fax s; "
        "email email s; situacao_especial situacao_especial s; data_situacao_especial data_situacao_especial d"
    ),
    "stg_rf_socio": (
        "data data d; ano ano i; mes mes i; cnpj_basico cnpj_basico 8; tipo tipo s; nome nome s; documento documento doc; qualificacao qualificacao p2; "
        "data_entrada_sociedade data_entrada_sociedade d; id_pais id_pais s; cpf_representante_legal cpf_representante_legal doc; "
        "nome_representante_legal nome_representante_legal s; qualificacao_representante_legal qualificacao_representante_legal p2; faixa_etaria faixa_etaria s"
    ),
}
#: Models whose year is a constant of the edition, and the part of the configuration that gives it.
YEARS = {m: "list_year" for m in MODELS if m.startswith("stg_valor")} | {
    m: "registry_year"
    for m in "stg_cvm_cia_aberta stg_cvm_fre_posicao_acionaria stg_cvm_fre_capital_social stg_cvm_fca_valor_mobiliario stg_susep_dado_cadastral stg_susep_receita_seguro stg_b3_empresa_listada stg_b3_empresa_listada_complemento".split()
}
#: Keys that checks assert; models without an entry have none.
KEYS = {
    "stg_valor_ranking": ["posicao"], "stg_valor_banco": ["posicao"], "stg_valor_seguradora": ["posicao"], "stg_cvm_cia_aberta": ["id_cvm"],
    "stg_cvm_fre_posicao_acionaria": ["id_cnpj", "data_referencia", "id_documento", "id_acionista"],
    "stg_cvm_fre_capital_social": ["id_cnpj", "id_documento", "tipo_capital", "id_capital_social"],
    "stg_bcb_entidade_supervisionada": ["id_cnpj"], "stg_bcb_ifdata_cadastro": ["id_instituicao"], "stg_bcb_ifdata_ativo_total": ["tipo_instituicao", "id_instituicao", "ano_mes", "conta"],
    "stg_susep_dado_cadastral": ["id_cnpj"], "stg_susep_receita_seguro": ["id_cnpj", "mes_referencia", "grupo", "ramo"], "stg_b3_empresa_listada": ["id_cnpj"],
    "stg_b3_empresa_listada_complemento": ["codigo_emissor"], "stg_b3_cotahist": ["ticker", "data_pregao"], "stg_rf_empresa": ["data", "cnpj_basico"], "stg_rf_estabelecimento": ["data", "cnpj"],
}
# --------------------------------------------------------------------------------


def columns_of(model: str) -> list[tuple[str, str, str]]:
    """(raw name, name, type) of a model's columns, in order."""
    return [tuple(c.split()) for c in MODELS[model].split("; ")]


def schema_of(model: str) -> T.StructType:
    """The contract of a model: names and types in order."""
    year = [T.StructField("ano", T.LongType())] if model in YEARS else []
    return T.StructType(year + [T.StructField(name, TYPES[kind][1]) for _, name, kind in columns_of(model)])


def stage(raw: DataFrame, model: str, config: Config = Config(), optional: Collection[str] = ()) -> DataFrame:
    """A raw table, all text, as its typed model; columns that the model does not name are not read.

    A raw column that is missing fails, unless it is among ``optional``: then it is null.
    """
    there = set(raw.columns)
    missing = sorted({s for s, _, _ in columns_of(model)} - there - set(optional))
    if missing:
        raise ValueError(f"{model}: no raw column {', '.join(missing)}")
    out = [F.lit(getattr(config, YEARS[model])).cast("long").alias("ano")] if model in YEARS else []
    for source, name, kind in columns_of(model):
        column = F.col(f"`{source}`") if source in there else F.lit(None).cast("string")
        out.append(TYPES[kind][0](column).cast(TYPES[kind][1]).alias(name))
    return raw.select(*out)


def describe_models(spark) -> DataFrame:
    """(modelo, ordem, original, nome, tipo): the declared columns of all models."""
    rows = [(m, i, s, n, TYPES[k][1].simpleString()) for m in MODELS for i, (s, n, k) in enumerate(columns_of(m), 1)]
    return spark.createDataFrame(rows, "modelo string, ordem int, original string, nome string, tipo string")
