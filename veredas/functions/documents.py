"""Company and person numbers. All are text: leading zeros count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hygiene import _col, clean_string, digits_only


def is_placeholder_cnpj(c: str | Column) -> Column:
    """Only zeros, at least one. False for null."""
    return F.coalesce(digits_only(c).rlike("^0+$"), F.lit(False))


def cnpj14(c: str | Column) -> Column:
    """A company number of 1 to 14 digits, padded; placeholders are null."""
    d = digits_only(c)
    return F.when(F.length(d).between(1, 14) & ~is_placeholder_cnpj(c), F.lpad(d, 14, "0"))


def cnpj8(c: str | Column) -> Column:
    """A company root of 1 to 8 digits, padded; zeros are allowed."""
    d = digits_only(c)
    return F.when(F.length(d).between(1, 8), F.lpad(d, 8, "0"))


def prefix8_from_cnpj14(c: str | Column) -> Column:
    d = digits_only(c)
    return F.when(F.length(d) == 14, F.left(d, F.lit(8)))


def identifying_document(c: str | Column) -> Column:
    """Digits where there are 14, 11 or 8 of them, else the text as typed (masks stay)."""
    d = digits_only(c)
    return F.when(F.length(d).isin(14, 11, 8), d).otherwise(clean_string(c))


def is_cpf11(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("string").rlike("^[0-9]{11}$"), F.lit(False))


def is_cnpj14(c: str | Column) -> Column:
    """Fourteen digits that are not all zero. False for null."""
    s = _col(c).cast("string")
    return F.coalesce(s.rlike("^[0-9]{14}$") & ~s.rlike("^0+$"), F.lit(False))


def cpf_mask6(c: str | Column) -> Column:
    """The six middle digits that a full and a masked person number share."""
    d = digits_only(c)
    return F.when(is_cpf11(c), F.substring(_col(c).cast("string"), 4, 6)).when(F.length(d) == 6, d)


def person_id_from_cpf(c: str | Column) -> Column:
    """``p-`` and 8 hexadecimals of the number's SHA-256. Reversible by trying numbers: personal data."""
    return F.concat(F.lit("p-"), F.substring(F.sha2(_col(c).cast("string"), 256), 1, 8))


def matriz_order(prefix: str = "") -> list[Column]:
    """Sort keys that put a company's active head office first."""
    col = lambda n: F.col(prefix + n)
    flag = lambda c: F.when(c, 0).otherwise(1)
    return [flag(col("identificador_matriz_filial") == "1"), flag(col("situacao_cadastral") == "02"), flag(col("cnpj_ordem") == "0001"), col("cnpj")]
