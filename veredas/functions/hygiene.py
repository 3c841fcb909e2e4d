"""Typed values out of raw text. Nothing here raises on bad text: it becomes null."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(38,9)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: str | Column) -> Column:
    """Text without white space of any kind at its ends; empty becomes null."""
    return F.nullif(F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def digits_only(c: str | Column) -> Column:
    return F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")


def padded_code(c: str | Column, width: int) -> Column:
    """Digits of a code, zero-padded to ``width``; longer codes are cut to it, none gives null."""
    d = digits_only(c)
    return F.when(F.length(d) > 0, F.lpad(d, width, "0"))


def to_int64(c: str | Column) -> Column:
    """Whole numbers only: ``12.7`` is null."""
    t = clean_string(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))


def to_float64(c: str | Column) -> Column:
    """Decimal or scientific notation; type suffixes such as ``5d`` are null."""
    t = clean_string(c)
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def to_numeric(c: str | Column) -> Column:
    """Exact money of 38 digits, 9 of them after the point."""
    t = clean_string(c)
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast(MONEY))


def parse_br_numeric(c: str | Column) -> Column:
    """``1.234.567,89`` and ``1234567.89`` alike: with a comma, points only group."""
    t = clean_string(c)
    return to_numeric(F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(t))


#: Accepted spellings of a date, tried in this order.
DATE_FORMS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$", "iso"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
)


def to_date(c: str | Column) -> Column:
    """Dates in ISO, ``dd/MM/yyyy``, ``yyyyMMdd`` or ``MM-dd-yyyy``; a bare year is null."""
    t = clean_string(c)
    found = F.lit(None).cast("date")
    for pattern, form in reversed(DATE_FORMS):
        read = t.try_cast("date") if form == "iso" else F.try_to_date(t, form)
        found = F.when(t.rlike(pattern), read).otherwise(found)
    return found


def to_date_yyyymmdd(c: str | Column) -> Column:
    t = clean_string(c)
    return F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd"))


def year_month(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyyMM")


@F.pandas_udf(T.StringType())
def _shortest(values: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else f"{v:g}" for v in values.astype(object)], dtype="object")


def short_number(c: str | Column) -> Column:
    """A number with at most six significant digits and no trailing zeros; null stays null.

    Rounded from the exact binary value, which the JVM's formatters do not do
    (they round the shortest decimal), hence the Arrow batch.
    """
    x = _col(c).cast("double")
    return F.when(x.isNotNull(), _shortest(F.coalesce(x, F.lit(0.0))))
