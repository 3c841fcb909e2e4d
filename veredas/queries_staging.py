"""Every staging model over raw text made from whole tables, with SQL that knows the values from before they became text.

``orders`` is written out as the raw table of a model: each raw column gets its
value in the spellings that its type has to cope with, and ``stage`` reads it
back. The SQL takes the value from ``orders`` itself and parses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .plans import staging
from .queries_core import table

CONFIG = Config()
QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Models that have a table of their own among the test tables; their queries stand with the pipeline.
OWN = ("stg_valor_ranking", "stg_rf_socio", "stg_rf_empresa", "stg_cvm_fre_posicao_acionaria", "stg_cvm_cia_aberta")

_KEY = "(o_orderkey + {i} + 1)"
_FULL = "substr({d}, 1, 2) || '.' || substr({d}, 3, 3) || '.' || substr({d}, 6, 3) || '/' || substr({d}, 9, 4) || '-' || substr({d}, 13, 2)"


def _numbered(width: int, of: str) -> str:
    return f"lpad(cast({_KEY} as {of}), {width}, '0')"


#: By type: how the value is typed (Spark SQL).
RAW = {
    "s": f"case when {_KEY} % 7 = 0 then '  ' else concat('  ', o_orderpriority, ' é ', {_KEY}, ' ') end",
    "i": f"case when {_KEY} % 5 = 0 then '12.7' when {_KEY} % 5 = 1 then concat(' +', {_KEY}) else concat({_KEY}, ' ') end",
    "f": f"case when {_KEY} % 5 = 0 then '5d' else concat(' ', o_totalprice) end",
    "n": f"case when {_KEY} % 5 = 0 then '1,5' else cast(cast(o_totalprice as decimal(15,2)) as string) end",
    "b": f"case when {_KEY} % 2 = 0 then translate(format_number(cast(o_totalprice as decimal(15,2)), 2), '.,', ',.') else cast(cast(o_totalprice as decimal(15,2)) as string) end",
    "d": f"case {_KEY} % 5 when 0 then date_format(o_orderdate, 'yyyy') when 1 then date_format(o_orderdate, 'dd/MM/yyyy') when 2 then date_format(o_orderdate, 'yyyyMMdd') "
    "when 3 then date_format(o_orderdate, 'MM-dd-yyyy') else concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 00:00') end",
    "e": f"case when {_KEY} % 5 = 0 then date_format(o_orderdate, 'yyyy-MM-dd') else date_format(o_orderdate, 'yyyyMMdd') end",
    "14": f"case when {_KEY} % 6 = 0 then '00.000.000/0000-00' else {_FULL.format(d=_numbered(14, 'string'))} end",
    "14x": f"case when {_KEY} % 2 = 0 then {_FULL.format(d=_numbered(14, 'string'))} else concat('sem ', {_KEY}) end",
    "8": f"concat(' ', {_KEY})",
    "doc": f"case {_KEY} % 3 when 0 then {_FULL.format(d=_numbered(14, 'string'))} when 1 then concat(' ***.', {_numbered(6, 'string')}, '-** ') else concat({_numbered(11, 'string')}, ' ') end",
    "p2": f"concat(' ', {_KEY} % 100)",
    "p4": f"concat({_KEY} % 10000, '')",
    "cents": "lpad(cast(cast(round(o_totalprice * 100) as bigint) as string), 13, '0')",
}
#: By type: the value that staging has to find (DuckDB).
VALUE = {
    "s": f"case when {_KEY} % 7 = 0 then null else o_orderpriority || ' é ' || {_KEY} end",
    "i": f"case when {_KEY} % 5 = 0 then null else {_KEY} end",
    "f": f"case when {_KEY} % 5 = 0 then null else o_totalprice end",
    "n": f"case when {_KEY} % 5 = 0 then null else cast(cast(o_totalprice as decimal(15,2)) as decimal(38,9)) end",
    "b": "cast(cast(o_totalprice as decimal(15,2)) as decimal(38,9))",
    "d": f"case when {_KEY} % 5 = 0 then null else cast(o_orderdate as date) end",
    "e": f"case when {_KEY} % 5 = 0 then null else cast(o_orderdate as date) end",
    "month": f"case when {_KEY} % 5 = 0 then null else strftime(o_orderdate, '%Y%m') end",
    "14": f"case when {_KEY} % 6 = 0 then null else {_numbered(14, 'varchar')} end",
    "14x": f"case when {_KEY} % 2 = 0 then {_numbered(14, 'varchar')} end",
    "typed 14x": f"case when {_KEY} % 2 = 0 then {_FULL.format(d=_numbered(14, 'varchar'))} else 'sem ' || {_KEY} end",
    "8": _numbered(8, "varchar"),
    "doc": f"case {_KEY} % 3 when 0 then {_numbered(14, 'varchar')} when 1 then '***.' || {_numbered(6, 'varchar')} || '-**' else {_numbered(11, 'varchar')} end",
    "p2": f"lpad(cast({_KEY} % 100 as varchar), 2, '0')",
    "p4": f"lpad(cast({_KEY} % 10000 as varchar), 4, '0')",
    "cents": "cast(cast(o_totalprice as decimal(15,2)) as decimal(38,9))",
}


def _kinds(model: str) -> dict[str, tuple[int, str]]:
    """Each raw column with its place and the type in which it is typed; a column that is read twice is typed for the narrower type."""
    out: dict[str, tuple[int, str]] = {}
    for source, _, kind in staging.columns_of(model):
        if source not in out:
            out[source] = (len(out), "d" if kind == "month" else kind)
        elif kind in ("14x", "d"):
            out[source] = (out[source][0], kind)
    return out


def _sql(model: str) -> str:
    typed = _kinds(model)
    columns = [f"cast({getattr(CONFIG, staging.YEARS[model])} as bigint) as ano"] if model in staging.YEARS else []
    for source, name, kind in staging.columns_of(model):
        place, raw = typed[source]
        value = VALUE["typed 14x" if kind == "s" and raw == "14x" else kind]
        columns.append(f"{value.format(i=place)} as {name}")
    return f"select {', '.join(columns)} from orders"


def _register() -> None:
    for model in staging.MODELS:
        if model in OWN:
            continue

        def staged(spark: SparkSession, folder: str, model: str = model) -> DataFrame:
            raw = [F.expr(RAW[kind].format(i=place)).alias(source) for source, (place, kind) in _kinds(model).items()]
            return staging.stage(table(spark, folder, "orders").select(*raw), model, CONFIG)

        QUERIES[f"staged_{model[4:]}"] = staged
        SQL[f"staged_{model[4:]}"] = _sql(model)


_register()
