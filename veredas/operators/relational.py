"""Small relational operators that the pipeline is composed of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group, the first by ``order``.

    Planned as a row number with a group limit, so a group is cut to one row
    before the shuffle. Give a total order where the pick has to be repeatable.
    Null keys form a group of their own; an empty table gives no rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_group(df: DataFrame, key: str, version: str) -> DataFrame:
    """All rows of each key's greatest ``version``, compared as it is typed (text by code points).

    Rows with a null key or version belong to no version and are left out.
    """
    latest = df.where(F.col(key).isNotNull() & F.col(version).isNotNull()).groupBy(key).agg(F.max(version).alias(version))
    return df.join(latest, [key, version], "left_semi")


def unique_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) for keys that occur in exactly one row; null keys group like others."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: dict[str, str]) -> DataFrame:
    """Adds to each row how many different non-null values its group has.

    ``counted`` maps new names to columns. Groups are counted once and joined
    back null-safely, so no set of values grows with a frequent key.
    """
    counts = df.groupBy(*keys).agg(*[F.countDistinct(c).alias(n) for n, c in counted.items()])
    renamed = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *counted)
    on = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = c if on is None else on & c
    return df.join(renamed, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def ordered_concat(df: DataFrame, keys: Sequence[str], text: Column, order: Sequence[Column], name: str, separator: str = "; ") -> DataFrame:
    """(keys, name): the group's texts joined in order, repeats kept, nulls left out."""
    items = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], text.alias("_t")))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["_t"]), separator).alias(name))


def flag_exists(df: DataFrame, other: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Adds whether a row with the same keys is in ``other``; false for null keys."""
    return df.join(other.select(*keys).distinct().withColumn(flag, F.lit(True)), list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def cascade(df: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]], name: str, last: Column) -> DataFrame:
    """Adds ``name``: the value of the first lookup that knows the row, else ``last``.

    Each lookup is (table with at most one row per key, keys, value column).
    """
    found = []
    out = df
    for i, (table, keys, value) in enumerate(lookups):
        out = out.join(table.select(*keys, F.col(value).alias(f"_v{i}")), list(keys), "left")
        found.append(F.col(f"_v{i}"))
    return out.withColumn(name, F.coalesce(*found, last)).drop(*[f"_v{i}" for i in range(len(found))])


def tagged_union(parts: dict[str, DataFrame], tag: str = "origem") -> DataFrame:
    """All rows of all parts, repeats kept, with the name of the part; missing columns are null."""
    out = None
    for name, df in parts.items():
        marked = df.withColumn(tag, F.lit(name))
        out = marked if out is None else out.unionByName(marked, allowMissingColumns=True)
    return out
