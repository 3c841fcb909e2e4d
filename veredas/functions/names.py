"""Comparable keys of company and person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .documents import is_cpf11, person_id_from_cpf
from .hygiene import _col

# --- fixed values -----------------------------------------------------------
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCNY"
LEGAL_SUFFIX = "(SA|LTDA|EIRELI)$"
# -----------------------------------------------------------------------------


def _typed(c: str | Column) -> Column:
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.upper(F.regexp_replace(text, r"^\s+|\s+$", ""))


def fold_upper(c: str | Column) -> Column:
    """Upper case without accents; null becomes empty."""
    return F.translate(_typed(c), ACCENTED, PLAIN)


def company_key(c: str | Column) -> Column:
    """Letters and digits only, ``&`` read as E and CIA as COMPANHIA. Never null."""
    folded = F.translate(F.replace(_typed(c), F.lit("&"), F.lit("E")), ACCENTED, PLAIN)
    spaced = F.concat(F.lit(" "), F.regexp_replace(folded, "[^A-Z0-9]", " "), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(spaced, " CIA ", " COMPANHIA "), "[^A-Z0-9]", "")


def person_key(c: str | Column) -> Column:
    """Upper case without accents, hyphens as spaces, single spaces. Never null."""
    spaced = F.replace(fold_upper(c), F.lit("-"), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(spaced, r"^\s+|\s+$", ""), r"\s+", " ")


def text_before_dash(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), " - .*", "")


def first_parenthetical(c: str | Column) -> Column:
    """What stands in the first parentheses; empty if there are none."""
    return F.regexp_extract(_col(c), r"\(([^)]+)\)", 1)


def strip_legal_suffix(key: str | Column) -> Column:
    return F.regexp_replace(_col(key), LEGAL_SUFFIX, "")


def token_count(key: str | Column) -> Column:
    return F.size(F.split(_col(key), " "))


def first_token(key: str | Column) -> Column:
    return F.element_at(F.split(_col(key), " "), 1)


def last_token(key: str | Column) -> Column:
    return F.element_at(F.split(_col(key), " "), -1)


def tokens_contained(inner: str | Column, outer: str | Column) -> Column:
    """Every token of ``inner`` is one of ``outer``, repeats aside."""
    return F.size(F.array_except(F.split(_col(inner), " "), F.split(_col(outer), " "))) == 0


def within_edits(a: str | Column, b: str | Column, most: int) -> Column:
    """Edit distance of at most ``most``; the search stops there."""
    return F.levenshtein(_col(a), _col(b), most) >= 0


def person_origin_id(document: str | Column, name: str | Column, company: str | Column) -> Column:
    """Id by number where it is whole, else by name within one company."""
    return F.when(is_cpf11(document), person_id_from_cpf(document)).otherwise(F.concat(F.lit("nome:"), person_key(name), F.lit("@"), _col(company)))
