"""Data-quality checks: each returns the rows that violate it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count; a combination with a null is none for a single column."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with another value; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships(df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null value no parent has."""
    known = parents.where(F.col(parent_column).isNotNull()).select(F.col(parent_column).alias(column))
    return df.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; unknown passes."""
    return df.where(f"not ({expression})")


def contract(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences in column names and types, in order; empty if there are none."""
    want = {f.name: f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    lost = [f"missing {n}" for n in want if n not in have]
    extra = [f"unexpected {n}" for n in have if n not in want]
    other = [f"{n} is {have[n].simpleString()}, not {want[n].simpleString()}" for n in want if n in have and have[n] != want[n]]
    return lost + extra + other


@dataclass(frozen=True)
class Check:
    """One named check over one table; ``where`` scopes it, ``severity`` is error or warn."""

    name: str
    violations: object
    severity: str = "error"
    where: str | None = None
    tags: tuple[str, ...] = field(default=())


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(verificacao, severidade, violacoes): how many rows violate each check."""
    out = None
    for c in checks:
        scoped = df.where(c.where) if c.where else df
        row = c.violations(scoped).agg(F.count(F.lit(1)).alias("violacoes")).select(F.lit(c.name).alias("verificacao"), F.lit(c.severity).alias("severidade"), "violacoes")
        out = row if out is None else out.unionByName(row)
    return out


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, unless it is empty."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def require_count(df: DataFrame, condition: Column, wanted: int, what: str) -> DataFrame:
    """``df``, if exactly ``wanted`` rows fulfil the condition."""
    got = df.agg(F.count_if(condition)).first()[0]
    if got != wanted:
        raise ValueError(f"{what}: {got} rows, not {wanted}")
    return df
