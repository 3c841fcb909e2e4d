"""Joins of names that begin with one another, and of names that nearly agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import first_token, last_token, token_count, tokens_contained, within_edits


def _lengths(df: DataFrame, key: str) -> list[int]:
    """The lengths that keys have; at most as many as the longest key has characters."""
    return sorted(r[0] for r in df.where(F.col(key).isNotNull()).select(F.length(key)).distinct().collect())


def prefix_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Pairs in which one key begins with the other, without comparing all pairs.

    A right key that begins with a left key meets it by its own leading part of
    that length, a left key that begins with a right key likewise: each side is
    copied once per length that the other side's keys have and it reaches. Both
    are equi-joins; equal keys are found by the first only. Before it is copied,
    the right side is reduced to rows that begin like some left key in as many
    characters as the shortest left key has, which needs no shuffle of a large
    right side while the left one is small.

    Null keys find nothing; an empty right key begins every left key and the
    other way round; repeated rows give repeated pairs. Columns of both sides
    pass through and must differ in name.
    """
    lengths_left, lengths_right = _lengths(left, left_key), _lengths(right, right_key)

    def parts(df: DataFrame, key: str, lengths: list[int], proper: bool) -> DataFrame:
        own = F.length(key) - (1 if proper else 0)
        reached = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= own)
        return df.withColumn("_n", F.explode(reached)).withColumn("_part", F.substring(F.col(key), F.lit(1), F.col("_n"))).drop("_n")

    least = lengths_left[0] if lengths_left else 0
    like = right
    if least:
        heads = left.where(F.col(left_key).isNotNull()).select(F.substring(F.col(left_key), 1, least).alias("_head")).distinct()
        like = right.where(F.length(right_key) >= least).withColumn("_head", F.substring(F.col(right_key), 1, least)).join(heads, "_head", "left_semi").drop("_head")
    longer = left.withColumn("_part", F.col(left_key)).join(parts(like, right_key, lengths_left, False), "_part").drop("_part")
    shorter = parts(left, left_key, lengths_right, True).join(right.withColumn("_part", F.col(right_key)), "_part").drop("_part")
    return longer.unionByName(shorter)


def fuzzy_block_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, edits: int = 2, least_tokens: int = 3) -> DataFrame:
    """Pairs of different keys with the same first and last token that nearly agree.

    They agree if they have equally many tokens and at most ``edits`` edits, or
    if both have ``least_tokens`` tokens and one has all tokens of the other.
    The block is an equi-join, the rest a residual filter. Null keys find nothing.
    """
    a = left.withColumns({"_f": first_token(left_key), "_l": last_token(left_key), "_n": token_count(left_key)})
    b = right.withColumns({"_f": first_token(right_key), "_l": last_token(right_key), "_m": token_count(right_key)})
    near = within_edits(left_key, right_key, edits) & (F.col("_n") == F.col("_m"))
    inside = (F.least("_n", "_m") >= least_tokens) & (tokens_contained(left_key, right_key) | tokens_contained(right_key, left_key))
    return a.join(b, ["_f", "_l"]).where((F.col(left_key) != F.col(right_key)) & (near | inside)).drop("_f", "_l", "_n", "_m")
