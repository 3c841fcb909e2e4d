"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A key with fewer rows than this is not hot.
HOT = 100_000


def hot_values(df: DataFrame, key: str, most: int = 200, at_least: int = HOT) -> list:
    """The values of ``key`` with ``at_least`` rows, the ``most`` largest of them.

    Counts are combined map-side, and the list is bounded by ``most``: any value
    left out holds fewer than ``1/most`` of the rows or fewer than ``at_least``.
    Null is never hot (an equi-join drops or passes it without a shuffle key).
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= at_least)
    return [r[0] for r in counted.orderBy(F.desc("count"), F.col(key)).limit(most).collect()]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: Sequence | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` that has at most one row per ``key``.

    Left rows of hot keys meet their right rows in a broadcast join, whose right
    side has one row per hot key and so at most ``len(hot)`` rows; all other rows
    are co-partitioned. Nothing is dropped: the two parts are united again.
    ``how`` is ``left`` or ``inner``. Null keys find no partner.
    """
    hot = hot_values(left, key) if hot is None else list(hot)
    other = right.hint(hint) if hint else right
    if not hot:
        return left.join(other, key, how)
    is_hot = F.col(key).isin(*hot)
    part_hot = left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how)
    part_cold = left.where(~is_hot | F.col(key).isNull()).join(other.where(~is_hot), key, how)
    return part_hot.unionByName(part_cold)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str],
    hot: Column,
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Equi-join where rows with ``hot`` true are spread over ``salts`` buckets.

    ``hot`` must be an expression over ``keys`` valid on both sides. Left rows of
    hot keys take the bucket of a hash of ``salt_by``; right rows of hot keys are
    copied into every bucket; other rows use bucket 0. ``how``: inner or left.
    """
    bucket = F.when(hot, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    a = left.withColumn("_salt", bucket)
    b = right.withColumn("_salt", F.explode(copies))
    return a.join(b, [*keys, "_salt"], how).drop("_salt")
