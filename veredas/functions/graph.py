"""Labels of graph nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hygiene import _col, short_number

# --- fixed values -----------------------------------------------------------
RELATIONS = {"acionista_controlador": "CONTROLADOR", "acionista": "ACIONISTA", "socio": "SOCIO"}
LABELS = {"pessoa": "Pessoa", "empresa": "Empresa", "estado": "Estado"}
ROLES = {"acionista_controlador": "controlador", "acionista": "acionista", "socio": "sócio"}
# -----------------------------------------------------------------------------


def _mapped(c: Column, pairs: dict[str, str], default: Column) -> Column:
    out = default
    for k, v in pairs.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def relation(role: str | Column) -> Column:
    return _mapped(_col(role), RELATIONS, F.lit("VINCULO"))


def node_label(kind: str | Column) -> Column:
    return _mapped(_col(kind), LABELS, F.lit("Parada"))


def edge_name(role: str | Column, source: str | Column, share_on: str | Column, share_total: str | Column) -> Column:
    """Role, source and the share known, joined by a middle dot."""
    role, source, on, total = _col(role), _col(source), _col(share_on), _col(share_total)
    share = (
        F.when(on.isNotNull(), F.concat(short_number(on), F.lit("% ON")))
        .when(total.isNotNull(), F.concat(short_number(total), F.lit("% total")))
        .when(source == "qsa", F.lit("sem %"))
    )
    return F.concat_ws(" · ", _mapped(role, ROLES, role), F.when(source == "fre", "FRE").otherwise("QSA"), share)


def frozen_edge_name(kind: str | Column, votes: str | Column) -> Column:
    """Who owns, and the share of votes where it is known; an edge without kind is plain ownership."""
    k = F.coalesce(_col(kind), F.lit("owns"))
    who = _mapped(k, {"person_owns": "pessoa", "company_owns": "empresa"}, k)
    return F.when(_col(votes).isNull(), who).otherwise(F.concat(who, F.lit(" "), short_number(votes), F.lit("%")))
